"""Scheduled refreshes as Structured Streaming jobs."""
