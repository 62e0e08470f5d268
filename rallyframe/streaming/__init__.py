"""Structured Streaming around the batch transforms."""
