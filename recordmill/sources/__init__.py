"""Scans and sinks: paged payloads, NDJSON files, the landing table, CSV, tables."""
