"""Structured Streaming: ingestion into bronze and live roll-ups."""
