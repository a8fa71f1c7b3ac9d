"""Operators for preparing training text: extraction, deduplication, filtering, mixing, encoding, search."""
