"""Scans with explicit schemas, JSON payload flattening, sinks."""
