"""Streaming queries over the flows."""
