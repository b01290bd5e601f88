"""Batch jobs composed from sources, operators and sinks."""
