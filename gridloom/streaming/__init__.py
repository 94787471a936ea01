"""Incremental ingest."""
