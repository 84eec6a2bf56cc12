"""Structured Streaming ingestion into bronze."""
