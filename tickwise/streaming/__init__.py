"""Structured Streaming ingest and snapshot maintenance."""
