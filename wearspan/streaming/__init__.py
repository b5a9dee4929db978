"""Structured Streaming forms of the request and window operators."""
