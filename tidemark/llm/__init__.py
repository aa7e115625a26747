"""Operators for cleaning, deduplicating, scoring and encoding training text."""
