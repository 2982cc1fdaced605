"""Operators for training-data pipelines: quality, de-duplication, archives, tokens."""
