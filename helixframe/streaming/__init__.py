"""Streaming feeds."""
