"""Streaming: incremental file-stream ingestion that upserts each micro-batch."""
