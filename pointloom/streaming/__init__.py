"""Structured Streaming: live snapshots, per-series state, and the micro-batch derivation job."""
