"""Structured Streaming forms of ingestion, telemetry and the daily mart."""
