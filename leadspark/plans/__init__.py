"""Composed reports, queues and cycles."""
