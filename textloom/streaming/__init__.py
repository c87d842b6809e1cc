"""Structured Streaming jobs."""

from textloom.streaming.scoring import score_stream, scored_stream

__all__ = ["score_stream", "scored_stream"]
