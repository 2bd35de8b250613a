"""Structured Streaming counterparts of polling with overlap."""

from hydrolake.streaming.streams import (
    FreshnessMonitor, daily_stream, dedup_stream, drain, freshness_stream, ingest_stream, upsert_stream,
)

__all__ = [n for n in dir() if not n.startswith("_")]
