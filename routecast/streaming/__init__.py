"""Incremental runs of the row-local staging layer with Structured Streaming."""
