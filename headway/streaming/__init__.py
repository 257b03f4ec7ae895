"""Structured Streaming: sinks, jobs and query life cycle."""
