"""Structured Streaming jobs for scoring and monitoring."""
