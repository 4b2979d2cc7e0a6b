"""Structured Streaming forms of what the batch pipeline does as data arrive."""
