"""Topic logs in and out of pools, with Structured Streaming."""
