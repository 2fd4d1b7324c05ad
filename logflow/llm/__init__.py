"""Operators of a training-data pipeline: archives, search, licenses, mixing, deduplication, packing, quality."""
