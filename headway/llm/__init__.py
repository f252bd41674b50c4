"""Operators for training-data pipelines: deduplication, filtering, extraction, mixing, tokens."""
