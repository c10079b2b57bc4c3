"""The analyses on live input, with Structured Streaming."""
