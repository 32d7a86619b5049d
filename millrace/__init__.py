"""Reusable, tested data operators on the DataFrame, Spark ML and Structured Streaming APIs."""
