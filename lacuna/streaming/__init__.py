"""Structured Streaming jobs: readiness, status and exactly-once output."""
