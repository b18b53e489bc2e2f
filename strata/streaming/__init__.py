"""Incremental loads with Structured Streaming."""

from strata.streaming.incremental import start_raw_stream

__all__ = ["start_raw_stream"]
