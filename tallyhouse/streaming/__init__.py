"""Structured Streaming entry points (incremental landing of rate files)."""
