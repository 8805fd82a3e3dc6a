"""Operators of a training-data pipeline: filters, scoring, search, near-duplicates, packing and archives."""
