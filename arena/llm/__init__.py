"""Operators of a training-data pipeline: integrity, filters, deduplication, scoring, mixing, formatting, packing."""
