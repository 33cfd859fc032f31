"""Registered queries over the check tables, and their SQL equivalents."""
