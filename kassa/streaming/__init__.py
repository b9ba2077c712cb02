"""Incremental ingestion of monthly sales files (Structured Streaming)."""
