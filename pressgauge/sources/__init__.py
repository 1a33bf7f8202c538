"""Readers, writers and the article store."""
