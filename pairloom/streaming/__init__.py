"""Structured Streaming forms of the scalar log."""
