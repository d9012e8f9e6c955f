"""Structured Streaming forms of the load and the rollups."""
