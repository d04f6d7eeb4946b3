"""Incremental ingestion and deduplication by Structured Streaming."""
