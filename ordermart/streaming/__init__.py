"""Structured Streaming: transaction source, keyed card state, scorer and sinks."""
