"""Picking up new releases with Structured Streaming."""
