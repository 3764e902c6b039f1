"""Live rollups on Structured Streaming."""
