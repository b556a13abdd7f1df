"""Streaming versions of ingest, hourly facts, dedup and late repair."""
