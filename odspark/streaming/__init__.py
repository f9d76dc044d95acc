"""Structured Streaming jobs over folders of request files."""
