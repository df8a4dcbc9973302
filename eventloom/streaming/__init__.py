"""Structured Streaming helpers: running queries to a sink, sinks, state."""
