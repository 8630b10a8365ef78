"""Readers, small persisted state, and published tables."""
