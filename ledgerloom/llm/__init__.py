"""Operators for preparing training text: deduplication, filtering, extraction, formatting, packing."""
