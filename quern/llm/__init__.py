"""Operators of a training-data pipeline: secrets, personal data, near-duplicates, tokens, packing."""
