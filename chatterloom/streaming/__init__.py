"""Structured Streaming queries and their control."""
