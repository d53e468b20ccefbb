"""Structured Streaming jobs: Bronze ingest, watermark dedup, windowed Gold, stream-stream SLA join."""
