"""Structured Streaming deployment of the observation feed (optional; the reference has no streams)."""
