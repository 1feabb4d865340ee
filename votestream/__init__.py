"""Counting votes that arrive as a stream, on Spark DataFrames and Structured Streaming."""
