"""Operators for training-data pipelines: language ID, extraction, deduplication, tokenisation and filters."""
