"""Structured Streaming versions of the ingestion and the insert-only merge."""
