"""Running the jobs as Structured Streaming queries."""
