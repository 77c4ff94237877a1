"""Operators for training data: cleaning, deduplication, mixing, formatting and archiving of text."""
