"""Incremental processing of landed bronze files with Structured Streaming."""
