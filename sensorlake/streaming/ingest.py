"""Streaming ingestion.

One file source over all sensor directories, the same cleaning rules as
the batch path, and a ``foreachBatch`` sink.  The checkpoint location is a
stable argument, so a restart resumes instead of re-reading every file.

Each micro-batch's new rows (valid, and not in the table yet) are computed
once, written beside the checkpoint and read from there by everything that
follows: quarantine, alerts, kept views, the table and the metrics.  So all
outputs show exactly what the table received, with one stamp.  The table is
written last; the steps before it leave markers, so a batch that is replayed
after a failure repeats none of them and goes on with the same rows.

Two de-duplication modes:

* ``dedup="table"`` (default): every micro-batch appends only readings the
  table does not hold yet.  Exact against everything ever written, batch
  ingests included; reads the table partitions that the batch touches.
* ``dedup="state"``: valid rows that repeat a reading word for word are first
  dropped by Spark's state, within ``dedup_delay`` of the newest event time of
  a valid row; the table is then asked as in the other mode, so a row that
  repeats an identity with other content is a conflict there as well.
  Rejected rows pass beside the state and its watermark.  Spark's operator
  also drops valid readings that lie further behind; they stay in the landing
  folder and ``plans.ingest.merge_late`` adds and counts them.

Per-batch metrics go to a small table partitioned by stream and batch and
overwritten per partition, so a replay rewrites the same row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sensorlake import model
from sensorlake.functions.timestamps import require_fixed_zone
from sensorlake.operators import reports
from sensorlake.operators.dedup import CONFLICTING, CONTENT, IDENTITY, NEW, STATUS
from sensorlake.operators.derive import EVENT_TIME, STAMP
from sensorlake.plans.exports import ROW_EXPORTS
from sensorlake.plans.ingest import accepted_rows, conflict_rows, rejected_rows, staged_rows, valid_flag
from sensorlake.session import bounded_state, list_names, remove_path
from sensorlake.sinks.warehouse import append_new, decided_rows, with_status, write_quarantine, write_warehouse
from sensorlake.sources.json_files import JSON_GLOB, path_exists, sensor_glob, stream_json
from sensorlake.sources.json_values import recover_types, stream_values
from sensorlake.streaming.latest import Steps, stream_id, update_latest, update_summary

#: New and conflicting rows of a batch, as they are staged.
DECIDED_SCHEMA = T.StructType([*model.WAREHOUSE_SCHEMA.fields, T.StructField(STATUS, T.StringType())])

DEFAULT_TRIGGER = "5 seconds"
# 5 files per sensor type and trigger; one source reads all types
DEFAULT_MAX_FILES = 5 * len(model.SENSOR_TYPES)


def readings_stream(
    spark: SparkSession,
    root: str,
    types: Iterable[str] = model.SENSOR_TYPES,
    max_files_per_trigger: int | None = DEFAULT_MAX_FILES,
    glob: str = JSON_GLOB,
    *,
    multi_line: bool,
) -> DataFrame:
    """S3: raw readings of every sensor type as one stream; at least one type's directory must exist.  With ``multi_line``
    files are read value by value, as in batches."""
    if not any(path_exists(spark, f"{root.rstrip('/')}/{t}") for t in types):
        raise FileNotFoundError(f"no directory of a sensor type under {root}")
    if multi_line:
        return stream_values(spark, sensor_glob(root, types), max_files_per_trigger, glob)
    return stream_json(spark, sensor_glob(root, types), max_files_per_trigger, glob, multi_line=False)


def _trigger(writer, available_now: bool, processing_time: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)


def start_ingest(
    spark: SparkSession,
    root: str,
    warehouse_path: str,
    checkpoint: str,
    *,
    multi_line: bool,
    quarantine_path: str | None = None,
    metrics_path: str | None = None,
    alerts_path: str | None = None,
    on_batch: Callable[[SparkSession, int], None] | None = None,
    available_now: bool = False,
    processing_time: str = DEFAULT_TRIGGER,
    max_files_per_trigger: int | None = DEFAULT_MAX_FILES,
    fmt: str = "parquet",
    query_name: str | None = None,
    dedup: str = "table",
    dedup_delay: str = "1 day",
    latest_path: str | None = None,
    latest_n: int = 10,
    summary_path: str | None = None,
    row_exports_path: str | None = None,
    glob: str = JSON_GLOB,
    typed_recovery: bool = False,
) -> StreamingQuery:
    """Raw JSON directories -> warehouse table, micro-batch by micro-batch.

    ``on_batch(spark, batch_id)`` runs after each batch is written (R5: e.g.
    rebuild the BI exports).  Errors propagate and stop the query before the
    batch is committed, so the batch is retried on restart, not lost.
    ``alerts_path``: the alerts among the new rows, as they come (R6, read with
    ``read_alerts``).  ``latest_path``: the ``latest_n`` most recent readings
    (R4, ``streaming.latest.read_latest``).  ``summary_path``: the reading
    summary (R5, X2, ``streaming.latest.read_summary``).  ``row_exports_path``:
    the row extracts of the BI exports, to which each batch appends its rows
    (R5, ``read_row_export``).  ``typed_recovery``: a value sent as text is read (``sources.json_values.recover_types``).
    """
    if dedup not in ("table", "state"):
        raise ValueError(f"dedup must be 'table' or 'state', not {dedup!r}")
    require_fixed_zone(spark)
    raw = readings_stream(spark, root, glob=glob, multi_line=multi_line, max_files_per_trigger=max_files_per_trigger)
    staged = staged_rows(recover_types(raw) if typed_recovery else raw).withColumn(STAMP, F.current_timestamp())
    if dedup == "state":
        # A copy of the time carries the watermark, so that both sides have the same columns.
        said = [EVENT_TIME if c == "timestamp" else c for c in CONTENT]
        once = (
            staged.filter(valid_flag())
            .withColumn("_time", F.col(EVENT_TIME))
            .withWatermark("_time", dedup_delay)
            .dropDuplicatesWithinWatermark([*IDENTITY, *said])
            .drop("_time")
        )
        staged = once.unionByName(staged.filter(~valid_flag()))
    # Rejected rows and raw fields are staged for those who ask for them; the table takes the valid ones.
    whole = bool(quarantine_path or metrics_path)
    if not whole:
        staged = accepted_rows(staged)
    stream, markers = stream_id(checkpoint), f"{checkpoint.rstrip('/')}/_steps"

    def process(batch: DataFrame, batch_id: int) -> None:
        # The caller's session: in that of a stream with state, whose number of partitions must not change, Spark plans
        # nothing adaptively, and each step would have as many tasks as there are shuffle partitions.
        session = spark
        steps = Steps(session, markers, batch_id)
        folder = f"{checkpoint.rstrip('/')}/_staged/{batch_id}"
        held = f"{folder}/{'rows' if whole else 'valid'}"
        replay = path_exists(session, f"{folder}/decided/_SUCCESS")
        if replay and path_exists(session, f"{held}/_SUCCESS"):  # the rows are there; the batch is run for Spark's own state
            batch.write.format("noop").mode("overwrite").save()
        else:  # also where the attempt before did not ask for the rejected rows
            batch.write.mode("overwrite").parquet(held)
        rows = session.read.schema(batch.schema).parquet(held)
        if not replay:
            decided_rows(accepted_rows(rows) if whole else rows, warehouse_path, fmt)[0].write.mode("overwrite").parquet(f"{folder}/decided")
        decided = session.read.schema(DECIDED_SCHEMA).parquet(f"{folder}/decided")
        new = with_status(decided, NEW)
        if quarantine_path:
            rejected, clashing = rejected_rows(rows), with_status(decided, CONFLICTING)
            if not clashing.isEmpty():
                rejected = rejected.unionByName(conflict_rows(clashing, rows))
            steps.once("quarantine", lambda: write_quarantine(rejected, quarantine_path, fmt))
        if alerts_path:
            steps.once("alerts", lambda: write_alerts(new, alerts_path, stream, batch_id))
        if latest_path:
            steps.once("latest", lambda: update_latest(new, latest_path, stream, batch_id, latest_n))
        if summary_path:
            steps.once("summary", lambda: update_summary(new, summary_path, stream, batch_id))
        if row_exports_path:
            steps.once("row_exports", lambda: write_row_exports(new, row_exports_path, stream, batch_id))
        if metrics_path:
            steps.once("metrics", lambda: write_batch_metrics(rows, decided, metrics_path, stream, batch_id))
        if replay:  # an earlier attempt may have written some of them
            append_new(new, warehouse_path, fmt)
        else:
            write_warehouse(new, warehouse_path, "append", fmt)
        if on_batch is not None:
            on_batch(session, batch_id)
        remove_path(session, folder)
        steps.forget_older()

    writer = staged.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    with bounded_state(spark):
        return _trigger(writer, available_now, processing_time).start()


def _write_part(rows: DataFrame, path: str, stream: str, batch_id: int, fmt: str = "parquet") -> None:
    """Rows of one batch, in a partition of its own that a replay writes again."""
    tagged = rows.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("long")})
    writer = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True)
    writer.partitionBy("stream", "batch_id").format(fmt).save(path)


def write_alerts(new: DataFrame, path: str, stream: str, batch_id: int) -> None:
    """The alerts among a batch's new rows."""
    _write_part(new.filter("is_alert"), path, stream, batch_id)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Every alert that the streams into ``path`` have met, once each."""
    return spark.read.parquet(path).drop("stream", "batch_id")


def write_row_exports(new: DataFrame, path: str, stream: str, batch_id: int) -> None:
    """A batch's new rows as further CSV parts of the row extracts of the BI exports, ``<path>/<name>/``.

    Parts lie in a folder per stream and batch, so a replay writes its own again and what earlier batches wrote is
    never touched; a batch without rows leaves no part."""
    for name in sorted(ROW_EXPORTS):
        _write_part(reports.BI_EXPORTS[name](new), f"{path.rstrip('/')}/{name}", stream, batch_id, "csv")


def read_row_export(spark: SparkSession, path: str, name: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A row extract as all batches so far have written it; None of its rows before the first batch that had one."""
    folder = f"{path.rstrip('/')}/{name}"
    if not path_exists(spark, folder) or not any(n.startswith("stream=") for n in list_names(spark, folder)):
        return reports.BI_EXPORTS[name](spark.createDataFrame([], model.WAREHOUSE_SCHEMA))
    rows = spark.read.option("header", True)
    if schema is not None:
        rows = rows.schema(schema)
    return rows.csv(folder).drop("stream", "batch_id")


def write_batch_metrics(staged: DataFrame, decided: DataFrame, path: str, stream: str, batch_id: int) -> None:
    """One row per micro-batch: rows read, valid and rejected; of the valid those written and their alerts, those
    in conflict with the table or each other, and the rest, which repeat a reading."""
    read = staged.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(valid_flag()).alias("rows_valid"),
        F.count_if(~valid_flag()).alias("rows_rejected"),
    )
    kept = decided.agg(
        F.count_if(F.col(STATUS) == NEW).alias("rows_written"),
        F.count_if((F.col(STATUS) == NEW) & F.col("is_alert")).alias("alerts"),
        F.count_if(F.col(STATUS) == CONFLICTING).alias("rows_conflicting"),
    )
    repeated = F.col("rows_valid") - F.col("rows_written") - F.col("rows_conflicting")
    one = read.join(kept).withColumns({"rows_repeated": repeated, "processed_at": F.current_timestamp()})
    _write_part(one, path, stream, batch_id)


def start_raw_archive(
    spark: SparkSession,
    root: str,
    archive_path: str,
    checkpoint: str,
    *,
    multi_line: bool,
    available_now: bool = False,
    processing_time: str = DEFAULT_TRIGGER,
    max_files_per_trigger: int | None = DEFAULT_MAX_FILES,
) -> StreamingQuery:
    """R2 (re-aimed): raw ("bronze") copy of every file, as Parquet, exactly once
    (file sink with its own commit log)."""
    raw = readings_stream(spark, root, multi_line=multi_line, max_files_per_trigger=max_files_per_trigger)
    writer = raw.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", archive_path)
    return _trigger(writer, available_now, processing_time).start()
