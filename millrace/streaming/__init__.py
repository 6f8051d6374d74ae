"""Structured Streaming jobs: files to bronze, checked changes to the silver snapshot."""
