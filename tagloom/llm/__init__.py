"""Operators of a training-data pipeline: quality, deduplication, search, mixing, packing."""
