"""Structured Streaming jobs: message scoring and hourly counts."""
