"""Operators for preparing training text: deduplication, counting, scoring, packing and formatting."""
