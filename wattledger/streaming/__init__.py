"""Structured Streaming queries over the message stream."""
