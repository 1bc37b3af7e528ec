"""Structured Streaming forms of the line's operators."""
