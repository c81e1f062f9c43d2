"""Resumable ingest on Structured Streaming."""

from aerostar.streaming.ingest import BATCH, counts_of, ingest_pages, land_pages, rejects_of

__all__ = ["ingest_pages", "land_pages", "rejects_of", "counts_of", "BATCH"]
