"""Readers, payload adapters and sinks."""
