"""Readers, cleaning and layer storage."""
