"""Structured Streaming ingest and incremental mart refresh."""
