"""Structured Streaming ingest."""
