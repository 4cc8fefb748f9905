"""Structured Streaming entry points (file-stream batch scoring)."""
