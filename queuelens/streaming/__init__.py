"""Structured Streaming forms of ingest and escalation."""
