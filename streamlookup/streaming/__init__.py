"""Running enrichments on Structured Streaming."""
