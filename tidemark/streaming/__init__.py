"""Structured Streaming: record decoding, landing with dead letters, stream dedupe."""
