"""Operators of a training-data pipeline: sharding, deduplication, quality, mixing, token output."""
