"""Structured Streaming use of the narrow text functions."""
