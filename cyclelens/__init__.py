"""Shared-vehicle log analytics on the Spark DataFrame and Structured Streaming APIs."""
