"""Structured Streaming forms of landing and of the windowed run metrics."""
