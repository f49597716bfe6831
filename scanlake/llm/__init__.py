"""Operators for training corpora: deduplication, filtering, tokenising, packing."""
