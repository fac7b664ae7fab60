"""Structured Streaming: ingest, keyed state, live quality."""
