"""Structured Streaming jobs: ingestion into the warehouse, raw archive,
live alerts, live per-type monitor and event-time hourly trends."""
