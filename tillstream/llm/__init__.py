"""Operators for training-data pipelines: sharding, mixing, deduplication, packing, scoring."""
