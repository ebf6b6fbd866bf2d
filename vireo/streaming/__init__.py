"""Structured Streaming sources, stateful queries, sinks and listeners."""
