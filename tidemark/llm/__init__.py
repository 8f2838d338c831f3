"""Operators for training-data pipelines: search, deduplication, filtering, scoring, mixing and packing."""
