"""Operators of a training-data pipeline: filters, deduplication, scans,
language-model scoring and packing over a ``documents`` table."""
