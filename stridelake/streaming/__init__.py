"""Structured Streaming counterparts: ingest, change events, sessionization and online ranges."""
