"""Structured Streaming: new-files-only ingestion and the incremental register job."""
