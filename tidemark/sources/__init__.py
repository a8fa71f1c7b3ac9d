"""Readers, writers and the views over the given tables."""
