"""Operators for building training corpora: deduplication, cleaning, mixing, tokenising, language and counts."""
