"""Structured Streaming forms of the append-only snapshots and the catalog upsert."""
