"""Structured Streaming: counts, sinks and the two ride jobs."""
