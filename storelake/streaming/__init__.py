"""Continuous form of the incremental load."""
