"""Operators of a training-data pipeline: deduplication, extraction, filtering, tokenising, sharding."""
