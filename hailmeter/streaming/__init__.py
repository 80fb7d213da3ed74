"""Incremental and continuous variants built on Structured Streaming."""
