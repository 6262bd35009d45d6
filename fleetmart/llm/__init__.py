"""Operators for preparing training text: extraction, filtering, language, deduplication, scoring, mixing, packing, search."""
