"""The label jobs as Structured Streaming queries."""
