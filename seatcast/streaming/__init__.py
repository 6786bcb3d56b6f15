"""Incremental snapshot ingestion with Structured Streaming."""
