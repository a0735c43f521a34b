"""Structured Streaming jobs: file loads, change log, refreshed summaries."""
