"""Report runs over one warehouse snapshot (A5, A14) and the BI export files.

The reference reloads and counts the table before every export.  Here the
aggregate reports share one reading summary (one scan of the table, then a
small table staged in the shared checkpoint folder that each report rolls
up); only row-level extracts read the table itself, each once.
Aggregated reports (bounded by their number of groups) are written as one
CSV file each.  Row-level extracts (every reading, every alert) grow with
the table, so they are written multi-part, one writer per partition: a
single writer would funnel the table through one task.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from sensorlake.operators import reports
from sensorlake.operators.summary import reading_summary
from sensorlake.session import remove_path, scratch_path
from sensorlake.sinks.csv import export_single_csv, write_csv

# row-level extracts: written multi-part
ROW_EXPORTS = {"raw_data", "critical_alerts"}
# reports whose rows grow with the days or machines: multi-part as well
GROWING_REPORTS = {"temperature_moyenne"}


class SharedSummary:
    """The reading summary of a snapshot, staged once for several reports
    (or given: e.g. the one a stream keeps current)."""

    def __init__(self, warehouse: DataFrame, summary: DataFrame | None = None):
        self.warehouse = warehouse
        self.path = None
        self.table = summary

    def source_for(self, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
        if fn not in reports.SUMMARY_REPORTS:
            return self.warehouse
        if self.table is None:
            spark = self.warehouse.sparkSession
            self.path = scratch_path(spark, "reading-summary")
            reading_summary(self.warehouse).write.parquet(self.path)
            self.table = spark.read.parquet(self.path)
        return self.table

    def close(self) -> None:
        if self.path is not None:
            remove_path(self.warehouse.sparkSession, self.path)


def run_reports(
    warehouse: DataFrame,
    reports_dir: str,
    registry: dict[str, Callable[[DataFrame], DataFrame]] = reports.DECISION_REPORTS,
) -> dict[str, str]:
    """A5: every decision report to ``<reports_dir>/<name>/`` (CSV with header)."""
    shared = SharedSummary(warehouse)
    try:
        return {
            name: write_csv(fn(shared.source_for(fn)), f"{reports_dir.rstrip('/')}/{name}", single_file=name not in GROWING_REPORTS)
            for name, fn in registry.items()
        }
    finally:
        shared.close()


def export_all(
    warehouse: DataFrame,
    reports_dir: str,
    registry: dict[str, Callable[[DataFrame], DataFrame]] = reports.BI_EXPORTS,
    summary: DataFrame | None = None,
) -> dict[str, float]:
    """Every BI export; returns seconds per export.

    Aggregates go to ``<reports_dir>/<name>.csv``, row-level extracts to the
    directory ``<reports_dir>/<name>/`` (overwritten, so an empty alert list
    leaves a header-only file and a stale list never survives).  ``summary``:
    a reading summary of ``warehouse`` already at hand.  Errors propagate.
    """
    timings = {}
    shared = SharedSummary(warehouse, summary)
    try:
        for name, fn in registry.items():
            t0 = time.time()
            df = fn(shared.source_for(fn))
            if name in ROW_EXPORTS:
                write_csv(df, f"{reports_dir.rstrip('/')}/{name}", single_file=False)
            else:
                export_single_csv(df, reports_dir, name)
            timings[name] = time.time() - t0
    finally:
        shared.close()
    return timings
