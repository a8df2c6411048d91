"""Operators over training text: scoring, near-duplicates, mixing, secrets, language, contamination, quality."""
