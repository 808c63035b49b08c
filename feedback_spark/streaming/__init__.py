"""Structured Streaming variants of ingest, counts and resume."""
