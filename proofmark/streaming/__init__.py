"""The monitors as Structured Streaming jobs."""
