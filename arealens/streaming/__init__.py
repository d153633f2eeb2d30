"""Scheduled incremental loads as Structured Streaming file sources."""

from arealens.streaming.landing import incremental_load, write_publication

__all__ = ["incremental_load", "write_publication"]
