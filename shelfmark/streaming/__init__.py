"""Incremental ingest of newly landed files."""
