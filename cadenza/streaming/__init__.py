"""Incremental landing of payload files with Structured Streaming."""

from cadenza.streaming.incremental import (  # noqa: F401
    LANDED_SCHEMA, incremental_landing, land_pages, pending_keys, read_sink,
)
