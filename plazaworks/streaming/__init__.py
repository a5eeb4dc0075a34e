"""The polling job as a Structured Streaming query."""
