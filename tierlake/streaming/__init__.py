"""Structured Streaming ingestion into the raw tier."""
