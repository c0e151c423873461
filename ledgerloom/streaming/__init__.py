"""Structured Streaming variant of the incremental load."""
