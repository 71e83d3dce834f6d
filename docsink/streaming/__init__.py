"""The changelog sink for Structured Streaming and batch jobs."""
