"""Structured Streaming flows over the shared operators."""
