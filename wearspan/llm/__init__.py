"""Operators of a training-data pipeline: text, vectors, pages, secrets and packing."""
