"""Structured Streaming: runs, decoding, de-duplication, enrichment, hourly statistics."""
