"""Structured Streaming jobs on the live capture feed."""
