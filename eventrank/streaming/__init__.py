"""Incremental versions of the ingest steps."""
