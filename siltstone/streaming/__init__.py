"""Structured Streaming: incremental ingest of trace shards."""
