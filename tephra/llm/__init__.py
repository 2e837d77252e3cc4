"""Operators of a training-data pipeline: quality, secrets, PII, tokens, URLs, near-duplicates, packing."""
