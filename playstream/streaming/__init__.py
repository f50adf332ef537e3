"""Structured Streaming jobs over news events."""
