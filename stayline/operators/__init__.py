"""Operators that Spark has no single function for."""
