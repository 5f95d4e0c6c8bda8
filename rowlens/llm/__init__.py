"""Operators for preparing training text: deduplication, search, sharding, filtering, token counts, mixing and packing."""
