"""Structured Streaming drivers for the incremental loads."""
