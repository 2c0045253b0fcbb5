"""Operators that prepare training text: extraction, deduplication, filtering, mixing, archives."""
