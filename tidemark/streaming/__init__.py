"""Structured Streaming jobs over change logs."""
