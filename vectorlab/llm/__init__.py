"""Operators for preparing training data: deduplication, filtering, scoring, extraction and packing of texts."""
