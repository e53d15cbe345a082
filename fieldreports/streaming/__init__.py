"""Incremental (Structured Streaming) form of the report intake."""
