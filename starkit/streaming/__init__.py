"""Streaming forms of the landing step (the reference has no stream
processing; only its append-only ingest maps onto a stream)."""

from starkit.streaming.landing import land_available, landed_stream

__all__ = ["land_available", "landed_stream"]
