"""Triggered (``availableNow``) Structured Streaming jobs."""
