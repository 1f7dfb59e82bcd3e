"""Readers for the given tables and for landed files."""
