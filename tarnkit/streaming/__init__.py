"""Streams into the lake: landing, and the split of late rows. Each is a Structured Streaming query with a sink of its own."""
