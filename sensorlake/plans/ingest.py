"""Batch ingestion (B1, C6, A18): raw JSON -> validated warehouse rows.

The raw files are parsed once: normalised rows, their parsed time, calendar
parts, alert flag and rejection reasons are written to a staging table
(Parquet, in a fresh folder under the session's shared checkpoint
directory).  That cuts the lineage — a lost executor never forces a re-read
of the raw JSON — and the quarantine write, the touched-day lookup and the
warehouse write all read the columnar staging table.  Acceptance counts are
observed on the staging write, so no extra count job runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import model
from sensorlake.functions.timestamps import require_fixed_zone
from sensorlake.operators.cleaning import normalise, with_reject_reasons
from sensorlake.operators.dedup import CONFLICTING, CONTENT, IDENTITY, NEW, STATUS, decide, partition_profile
from sensorlake.operators.derive import EVENT_TIME, STAMP, warehouse_columns, with_calendar, with_event_time
from sensorlake.session import list_names, observation, remove_path, scratch_path
from sensorlake.sinks.warehouse import append_new, decided_rows, with_status, write_quarantine, write_warehouse, writer_count
from sensorlake.sources.json_files import JSON_GLOB, path_exists, read_json, sensor_dirs
from sensorlake.sources.json_values import read_values, recover_types
from sensorlake.sources.ledger import changed_corrupt_files, note_files, unread_files
from sensorlake.sources.warehouse import table_exists

REASONS = "reject_reasons"


@dataclass
class IngestReport:
    """``total`` = ``valid`` + ``rejected``; ``valid`` = ``written`` + ``repeated`` + ``conflicting`` where the table held nothing else."""

    total: int = 0
    valid: int = 0
    rejected: int = 0
    quarantined: int = 0
    conflicting: int = 0
    repeated: int = 0
    written: int = 0
    alerts: int = 0

    def frame(self, spark: SparkSession) -> DataFrame:
        """The run summary as one row."""
        return spark.createDataFrame([tuple(asdict(self).values())], ", ".join(f"{k} long" for k in asdict(self)))


def staged_rows(raw: DataFrame) -> DataFrame:
    """Raw rows -> normalised rows with parsed time, calendar, alert flag and
    rejection reasons (works on batch and streaming frames)."""
    timed = with_event_time(normalise(raw))
    return with_calendar(with_reject_reasons(timed, REASONS, parsed_time=EVENT_TIME))


def valid_flag() -> F.Column:
    return F.size(REASONS) == 0


def accepted_rows(staged: DataFrame) -> DataFrame:
    """Valid staged rows as warehouse rows; a stamp that was staged is kept."""
    return warehouse_columns(staged.filter(valid_flag()))


def rejected_rows(staged: DataFrame) -> DataFrame:
    """Rejected staged rows with the raw fields, reasons and source file."""
    return staged.filter(~valid_flag()).select(*_rejected_columns(staged))


def _rejected_columns(staged: DataFrame) -> list[str]:
    extra = (model.CORRUPT_COLUMN, model.SOURCE_FILE_COLUMN, model.SOURCE_MODIFIED_COLUMN, model.SOURCE_PLACE_COLUMN, REASONS)
    return [c for c, _ in model.RAW_FIELDS] + [c for c in extra if c in staged.columns]


CONFLICT = "repeated_id_with_other_content"


def conflict_rows(conflicts: DataFrame, staged: DataFrame) -> DataFrame:
    """Conflicting warehouse rows as rejected rows: the staged rows that say the same, each with its file."""
    held = conflicts.select(*[F.col(c).alias(f"_{c}") for c in (*IDENTITY, *CONTENT)]).distinct()
    valid = staged.filter(valid_flag())
    same = [valid[EVENT_TIME if c == "timestamp" else c].eqNullSafe(F.col(f"_{c}")) for c in (*IDENTITY, *CONTENT)]
    met = valid.join(held, same, "left_semi").withColumn(REASONS, F.array(F.lit(CONFLICT)))
    return met.select(*[c for c in _rejected_columns(staged)])


def ingest_frame(
    raw: DataFrame,
    warehouse_path: str,
    quarantine_path: str | None = None,
    mode: str = "append",
    fmt: str = "parquet",
    on_new: Callable[[DataFrame], None] | None = None,
    on_done: Callable[[DataFrame], None] | None = None,
) -> IngestReport:
    """Ingest already-read raw rows (batch DataFrame).

    ``on_new`` gets the staged new rows before the table does, ``on_done`` all staged rows behind it.  Without a valid row nothing is written, in ``overwrite`` mode as well:
    the table stays as it is."""
    spark = raw.sparkSession
    require_fixed_zone(spark)
    obs = observation("acceptance")
    staged = staged_rows(raw).withColumn(STAMP, F.current_timestamp()).observe(
        obs,
        F.count(F.lit(1)).alias("total"),
        F.count_if(valid_flag()).alias("valid"),
        F.count_if(~valid_flag()).alias("rejected"),
    )
    stage_path = scratch_path(spark, "ingest-stage")
    staged.write.parquet(stage_path)
    try:
        counts = obs.get
        report = IngestReport(int(counts["total"]), int(counts["valid"]), int(counts["rejected"]))
        table = spark.read.parquet(stage_path)
        rows = accepted_rows(table)
        if mode == "overwrite":
            profile = partition_profile(rows)
            decisions = decide(rows)
        else:
            decisions, profile = decided_rows(rows, warehouse_path, fmt)
        if not profile.empty:
            # Decided once, before the write: afterwards the table holds the new rows.
            clashes = observation("conflicts")
            met = [F.count_if(F.col(STATUS) == s).alias(s) for s in (NEW, CONFLICTING)]
            decisions.observe(clashes, *met).write.parquet(f"{stage_path}-decided")
            decided = spark.read.schema(decisions.schema).parquet(f"{stage_path}-decided")
            n_new, report.conflicting = (int(clashes.get[s] or 0) for s in (NEW, CONFLICTING))
            if quarantine_path and (report.rejected or report.conflicting):
                rejected = rejected_rows(table)
                if report.conflicting:
                    rejected = rejected.unionByName(conflict_rows(with_status(decided, CONFLICTING), table))
                report.quarantined = write_quarantine(rejected, quarantine_path, fmt)
            if n_new:
                fresh = with_status(decided, NEW)
                if on_new is not None:
                    on_new(fresh)
                result = write_warehouse(fresh, warehouse_path, mode, fmt, writer_count(spark, profile))
                report.written, report.alerts = result.written, result.alerts
            report.repeated = report.valid - report.written - report.conflicting
        elif quarantine_path and report.rejected:
            report.quarantined = write_quarantine(rejected_rows(table), quarantine_path, fmt)
        if on_done is not None:
            on_done(table)
        return report
    finally:
        remove_path(spark, stage_path)
        remove_path(spark, f"{stage_path}-decided")


def merge_late(
    spark: SparkSession,
    raw_root: str,
    warehouse_path: str,
    *,
    multi_line: bool,
    fmt: str = "parquet",
    quarantine_path: str | None = None,
    alerts_path: str | None = None,
    latest_path: str | None = None,
    latest_n: int = 10,
    summary_path: str | None = None,
    glob: str = JSON_GLOB,
) -> int:
    """Adds the landed readings that a stream with ``dedup="state"`` left behind its watermark; returns their number.

    An idempotent batch ingest of the landed files: what the table holds stays as it is.  Pass the paths that
    the stream has: late conflicts go to the quarantine, late readings to the alerts and kept views, before the
    table.  The late rows are staged beside the table (``<warehouse_path>.late``) under the merge's own number; a
    merge that failed is finished from there, steps that ended are not repeated, and only then are the landed files
    read again, so nothing is counted twice whatever has landed meanwhile.  The stream must not run meanwhile."""
    from sensorlake.streaming.ingest import write_alerts
    from sensorlake.streaming.latest import Steps, stream_id, update_latest, update_summary

    root = f"{warehouse_path.rstrip('/')}.late"
    stream, done = stream_id(root), f"{root}/_steps"

    def views(number: int) -> DataFrame:
        new = spark.read.schema(model.WAREHOUSE_SCHEMA).parquet(f"{root}/{number}")
        steps = Steps(spark, done, number)
        if alerts_path:
            steps.once("alerts", lambda: write_alerts(new, alerts_path, stream, number))
        if latest_path:
            steps.once("latest", lambda: update_latest(new, latest_path, stream, number, latest_n))
        if summary_path:
            steps.once("summary", lambda: update_summary(new, summary_path, stream, number))
        return new

    staged = sorted(int(n) for n in list_names(spark, root) if n.isdigit())
    last = max([*staged, *(int(n) for n in list_names(spark, done) if n.isdigit())], default=-1)
    finished = 0
    for number in staged:
        if path_exists(spark, f"{root}/{number}/_SUCCESS"):
            finished += append_new(views(number), warehouse_path, fmt).written
        remove_path(spark, f"{root}/{number}")
    number = last + 1

    def keep(new: DataFrame) -> None:
        new.write.mode("overwrite").parquet(f"{root}/{number}")
        views(number)

    report = ingest_batch(spark, raw_root, warehouse_path, quarantine_path, fmt=fmt, glob=glob, multi_line=multi_line, on_new=keep)
    remove_path(spark, f"{root}/{number}")
    steps = Steps(spark, done, number)
    steps.once("merged", lambda: None)  # the number is spent, also without late rows
    steps.forget_older()
    return finished + report.written


def ingest_batch(
    spark: SparkSession,
    raw_root: str | None,
    warehouse_path: str,
    quarantine_path: str | None = None,
    mode: str = "append",
    fmt: str = "parquet",
    types: Iterable[str] = model.SENSOR_TYPES,
    paths: Sequence[str] | None = None,
    glob: str = JSON_GLOB,
    *,
    multi_line: bool,
    on_new: Callable[[DataFrame], None] | None = None,
    ledger_path: str | None = None,
    typed_recovery: bool = False,
) -> IngestReport:
    """B1: read every populated type directory under ``raw_root`` (or ``paths``)
    and ingest it.  No input -> nothing is written.

    ``multi_line``: true for files of JSON values in any layout, read whole and
    value by value; false for one object per line, in files of any size.
    ``ledger_path``: a record of the files that were read (``sources.ledger``);
    only new and changed files are opened, and entered once they are in the
    table.  The driver holds the list of those files, as their listing does.
    ``typed_recovery``: a value sent as text is read (``recover_types``)."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    paths = list(paths) if paths else sensor_dirs(spark, raw_root, types, glob)
    if not paths:
        return IngestReport()
    if ledger_path is None:
        return ingest_frame(_read(spark, paths, glob, multi_line, typed_recovery), warehouse_path, quarantine_path, mode, fmt, on_new)
    files = unread_files(spark, paths, ledger_path, glob).collect()
    return _ingest_files(spark, files, warehouse_path, quarantine_path, mode, fmt, on_new, ledger_path, multi_line, typed_recovery)


def _read(spark: SparkSession, paths: Sequence[str], glob: str | None, multi_line: bool, typed_recovery: bool) -> DataFrame:
    raw = read_values(spark, paths, glob) if multi_line else read_json(spark, paths, glob=glob, multi_line=False)
    return recover_types(raw) if typed_recovery else raw


def _ingest_files(spark, files, warehouse_path, quarantine_path, mode, fmt, on_new, ledger_path, multi_line, typed_recovery) -> IngestReport:
    if not files:
        return IngestReport()
    raw = _read(spark, [f["location"] for f in files], None, multi_line, typed_recovery)
    return ingest_frame(raw, warehouse_path, quarantine_path, mode, fmt, on_new, lambda staged: note_files(files, staged, ledger_path))


def second_look(
    spark: SparkSession,
    raw_root: str,
    warehouse_path: str,
    quarantine_path: str,
    ledger_path: str,
    *,
    multi_line: bool,
    fmt: str = "parquet",
    glob: str = JSON_GLOB,
    types: Iterable[str] = model.SENSOR_TYPES,
    on_new: Callable[[DataFrame], None] | None = None,
) -> IngestReport:
    """Ingests the files that gave corrupt records and were written again since, e.g. those that a stream met half
    written; call it from time to time, or after each micro-batch (``on_batch``).  What was read of them before stays as
    it is, and their old quarantined rows count as healed (``ledger.with_healed``)."""
    paths = sensor_dirs(spark, raw_root, types, glob)
    if not paths or not table_exists(spark, quarantine_path):
        return IngestReport()
    files = changed_corrupt_files(spark, paths, quarantine_path, ledger_path, glob).collect()
    return _ingest_files(spark, files, warehouse_path, quarantine_path, "append", fmt, on_new, ledger_path, multi_line, False)
