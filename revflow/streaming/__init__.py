"""Structured Streaming: bronze ingest (T1, T2) and continuous current state (T5)."""
