"""End-to-end experiments and the driver-table query catalogue."""

from __future__ import annotations


def catalogue():
    """Import every query module (registration happens on import)."""
    from cadenza.plans import (  # noqa: F401
        clean_queries, ingest_queries, label_queries, metric_queries, profile_queries,
        sample_queries, payload_queries, coverage_queries, ml_queries, file_queries,
    )
    from cadenza.plans.registry import ORACLES, QUERIES
    return QUERIES, ORACLES
