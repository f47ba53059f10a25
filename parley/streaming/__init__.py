"""Structured Streaming queries. They reuse the batch operators unchanged."""
