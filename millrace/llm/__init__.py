"""Operators for building training data: quality, duplicates, leaks, secrets, scoring, extraction, packing."""
