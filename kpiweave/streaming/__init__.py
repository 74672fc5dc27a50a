"""Structured Streaming: validation, deduplication, windowed counts, alerts, mart refresh."""
