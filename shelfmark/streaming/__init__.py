"""Structured Streaming ingest of catalogue messages."""
