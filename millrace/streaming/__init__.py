"""Continuous upkeep with Structured Streaming."""
