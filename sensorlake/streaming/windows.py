"""Event-time windows in the stream (X2): readings per hour and type as Spark's own windowed state.

The state has one row per window and type, some 72 a day, however many readings
there are, so by default it is kept for good and no reading is ever late.  With
a ``delay`` Spark forgets windows that lie further behind the newest reading
and drops what still comes for them; those readings are counted in the query's
progress and in ``late_readings``.

Every trigger's changed windows are written as a part of their own (update mode,
an upsert by window, type and batch; a replay writes its part again), and from
time to time all windows as one part, in whose place the earlier ones go.
Readers take the newest row of each window.

The windows count readings as they are sent.  Repeated files count again; the
trends without repeats are ``monitor.hourly_windows`` over what the table took.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlake.functions.timestamps import require_fixed_zone
from sensorlake.operators.derive import EVENT_TIME
from sensorlake.operators.summary import Measures
from sensorlake.plans.ingest import staged_rows, valid_flag
from sensorlake.session import bounded_state, list_names, remove_path
from sensorlake.sources.json_files import JSON_GLOB, path_exists
from sensorlake.streaming.ingest import DEFAULT_MAX_FILES, DEFAULT_TRIGGER, _trigger, _write_part, readings_stream
from sensorlake.streaming.latest import stream_id

#: Triggers after which the parts are folded into one.
FOLD = 100
WINDOWS_SCHEMA = "window_start timestamp, window_end timestamp, type string, nombre_mesures bigint, valeur_moyenne double, alertes bigint, stream string, batch_id bigint"


def windowed(readings: DataFrame, delay: str | None = None, width: str = "1 hour") -> DataFrame:
    """Valid staged readings (batch or stream) per event-time window and type, with the columns of ``hourly_windows``."""
    m = Measures(readings)
    timed = readings.withWatermark(EVENT_TIME, delay) if delay else readings
    measures = [m.count().alias("nombre_mesures"), m.avg(2).alias("valeur_moyenne"), m.alerts().alias("alertes")]
    return (
        timed.groupBy(F.window(EVENT_TIME, width), "type")
        .agg(*measures)
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "type", "nombre_mesures", "valeur_moyenne", "alertes")
    )


def start_windows(
    spark: SparkSession,
    root: str,
    path: str,
    checkpoint: str,
    *,
    multi_line: bool,
    delay: str | None = None,
    width: str = "1 hour",
    available_now: bool = False,
    processing_time: str = DEFAULT_TRIGGER,
    max_files_per_trigger: int | None = DEFAULT_MAX_FILES,
    glob: str = JSON_GLOB,
    fold: int = FOLD,
) -> StreamingQuery:
    """Raw JSON directories -> windows under ``path``, kept current trigger by trigger (``read_windows``)."""
    require_fixed_zone(spark)
    raw = readings_stream(spark, root, max_files_per_trigger=max_files_per_trigger, glob=glob, multi_line=multi_line)
    stream = stream_id(checkpoint)

    def upsert(changed: DataFrame, batch_id: int) -> None:
        session = changed.sparkSession
        # Shuffled, not coalesced: one task over all partitions of the state would hold the buffers of each until its end.
        _write_part(changed.repartition(1), path, stream, batch_id)
        if (batch_id + 1) % fold == 0:
            # All windows in this batch's part; a crash before the earlier parts are gone leaves rows that lose to these.
            folder = f"{path.rstrip('/')}/stream={stream}"
            aside = f"{folder}/_folded"
            read_windows(session, path, stream, drop=False).repartition(1).write.mode("overwrite").parquet(aside)
            _write_part(session.read.schema(WINDOWS_SCHEMA).parquet(aside).drop("stream", "batch_id"), path, stream, batch_id)
            for n in list_names(session, folder):
                if n.startswith("batch_id=") and int(n.removeprefix("batch_id=")) < batch_id:
                    remove_path(session, f"{folder}/{n}")
            remove_path(session, aside)

    rows = windowed(staged_rows(raw).filter(valid_flag()), delay, width)
    writer = rows.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    with bounded_state(spark):
        return _trigger(writer, available_now, processing_time).start()


def read_windows(spark: SparkSession, path: str, stream: str | None = None, drop: bool = True) -> DataFrame:
    """The windows as they stand: of each, the row of the last trigger that changed it."""
    rows = spark.read.schema(WINDOWS_SCHEMA).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], WINDOWS_SCHEMA)
    rows = rows.filter(F.col("stream") == stream) if stream else rows
    keys = ["stream", "window_start", "window_end", "type"]
    measures = ["nombre_mesures", "valeur_moyenne", "alertes", "batch_id"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*measures), "batch_id").alias("m")).select(*keys, "m.*")
    return newest.drop("stream", "batch_id") if drop else newest


def late_readings(query: StreamingQuery) -> int:
    """Readings that a query with a ``delay`` has dropped as late, over the triggers that its progress remembers."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p["stateOperators"])
