"""Blockchain execution data as DataFrames, in batch and in streams."""
