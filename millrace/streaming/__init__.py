"""Structured Streaming jobs: log lines, word counts, and how to run them."""
