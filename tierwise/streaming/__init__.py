"""Structured Streaming entry points (E5)."""
