"""The two data flows, declared once for batch and stream."""
