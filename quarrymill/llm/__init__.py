"""Operators of a training-data pipeline: filters, dedup, mixing, tokens, packing."""
