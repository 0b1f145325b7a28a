"""Incremental landing of extracted increments with Structured Streaming."""
