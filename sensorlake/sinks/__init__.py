"""Sinks: the partitioned warehouse table (idempotent append), the quarantine
table, and CSV report files."""
