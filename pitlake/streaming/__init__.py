"""Incremental ingest: M4 batch resume (replay_ingest) and T-S1 Structured Streaming (stream_ingest)."""

from pitlake.streaming.ingest import replay_ingest, stream_ingest

__all__ = ["replay_ingest", "stream_ingest"]
