"""Batch sinks and table management. Each write can be repeated without changing the result."""
