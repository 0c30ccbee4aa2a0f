"""Readers, and the tables they expose."""
