"""Readers: telemetry messages, change records, history tables."""
