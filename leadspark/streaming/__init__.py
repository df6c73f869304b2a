"""Structured Streaming forms of the cycles and reports."""
