"""Operators for training text: archives, tokens, quality, language, duplicates, sharding."""
