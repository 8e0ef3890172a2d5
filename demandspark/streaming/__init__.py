"""Structured Streaming ingest of sales and reorders."""
