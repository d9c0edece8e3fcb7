"""Structured Streaming: incremental ingest and event counts."""
