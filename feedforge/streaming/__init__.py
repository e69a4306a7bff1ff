"""Incremental ingest and event-time operators."""
