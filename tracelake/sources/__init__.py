"""Readers of landed traces, blocks, receipts and progress rows, and writers of the tables."""
