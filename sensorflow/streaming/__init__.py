"""Structured Streaming versions of ingest, scoring and rates."""
