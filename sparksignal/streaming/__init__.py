"""Structured Streaming forms of the collection and aggregation jobs."""
