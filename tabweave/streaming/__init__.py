"""Structured Streaming over query specifications."""
