"""Structured Streaming speed layer."""
