"""Filings and resource-event analytics as Spark DataFrame and Structured Streaming jobs."""
