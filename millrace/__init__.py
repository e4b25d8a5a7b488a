"""Data-engineering operators over Spark DataFrames and Structured Streaming."""
