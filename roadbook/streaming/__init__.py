"""Structured Streaming entry points for the stateless crash stages."""
