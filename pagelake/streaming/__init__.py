"""Structured Streaming forms of the page transforms."""
