"""Readers; every schema is declared or read as strings, never inferred."""
