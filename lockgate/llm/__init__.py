"""Operators that prepare training text: filtering, deduplication, mixing, packing."""
