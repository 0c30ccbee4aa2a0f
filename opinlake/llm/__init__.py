"""Operators that prepare training data: deduplication, filtering, decontamination, tokens."""
