"""Live monitor (R4), periodic export refresh (R5) and hourly trends (X2), from
the views that ``start_ingest`` keeps (``sensorlake.streaming.latest``): they
show exactly what the table received, and nothing is dropped as late.
``sensorlake.streaming.windows`` has the trends as windows of the stream itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import model
from sensorlake.operators import reports
from sensorlake.operators.summary import Measures
from sensorlake.session import part_files, remove_path, replace_file
from sensorlake.sources.warehouse import read_warehouse, table_exists
from sensorlake.streaming.latest import read_latest, read_summary


def _publish(df: DataFrame, path: str) -> None:
    """Replaces the one file of a small published table in one step, so that readers find the old or the new rows."""
    spark, aside = df.sparkSession, f"{path.rstrip('/')}.next"
    df.coalesce(1).write.mode("overwrite").parquet(aside)
    (part,) = part_files(spark, aside)
    replace_file(spark, part, f"{path.rstrip('/')}/part-published.parquet")
    remove_path(spark, aside)


def _table_so_far(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The table as the batches have written it; no rows before the first valid one, as a batch may have none."""
    return read_warehouse(spark, path, fmt) if table_exists(spark, path) else spark.createDataFrame([], model.WAREHOUSE_SCHEMA)


def monitor_publisher(
    warehouse_path: str,
    out_dir: str,
    n: int = 10,
    fmt: str = "parquet",
    summary_path: str | None = None,
    latest_path: str | None = None,
):
    """R4 as an ``on_batch`` callback for ``start_ingest``: after each
    micro-batch, the per-type figures and the ``n`` latest readings are
    written to ``<out_dir>/stats`` and ``<out_dir>/latest``.

    With ``summary_path`` / ``latest_path`` (the views ``start_ingest`` keeps
    current) nothing reads the table.  Without them, both are computed from
    the table: a partial aggregate and a per-task top-k, fine for modest
    tables; on a large one, pass the views.
    """

    def publish(spark: SparkSession, batch_id: int) -> None:
        batch = F.lit(batch_id).cast("long")
        summary = read_summary(spark, summary_path) if summary_path else None
        stats = reports.monitor_stats(summary if summary is not None else _table_so_far(spark, warehouse_path, fmt))
        if latest_path:
            latest = read_latest(spark, latest_path, n)
        else:
            latest = reports.latest_readings(_table_so_far(spark, warehouse_path, fmt), n)
        _publish(stats.withColumn("batch_id", batch), f"{out_dir}/stats")
        _publish(latest.withColumn("batch_id", batch), f"{out_dir}/latest")

    return publish


def export_refresher(
    warehouse_path: str,
    reports_dir: str,
    fmt: str = "parquet",
    summary_path: str | None = None,
    include_row_exports: bool = False,
):
    """An ``on_batch`` callback for ``start_ingest`` that rebuilds the BI
    exports after every micro-batch.

    With ``summary_path`` (the summary ``start_ingest`` keeps current) the
    aggregate exports roll up that summary: no table scan per trigger.  The row
    extracts (every reading, every alert) grow with the table; ``start_ingest``
    appends each batch's own rows to them (``row_exports_path``, the same
    ``reports_dir``).  ``include_row_exports`` rewrites them whole instead,
    which suits small tables.
    """

    def refresh(spark: SparkSession, batch_id: int) -> None:
        from sensorlake.plans.exports import ROW_EXPORTS, export_all

        registry = {
            k: v for k, v in reports.BI_EXPORTS.items() if include_row_exports or k not in ROW_EXPORTS
        }
        summary = read_summary(spark, summary_path) if summary_path else None
        export_all(_table_so_far(spark, warehouse_path, fmt), reports_dir, registry, summary=summary)

    return refresh


def hourly_windows(readings: DataFrame) -> DataFrame:
    """Per event-time hour and type, from warehouse rows or the kept summary."""
    m = Measures(readings)
    start = F.make_timestamp("year", "month", "day", "hour", F.lit(0), F.lit(0))
    return (
        readings.groupBy("year", "month", "day", "hour", "type")
        .agg(m.count().alias("nombre_mesures"), m.avg(2).alias("valeur_moyenne"), m.alerts().alias("alertes"))
        .select(
            start.alias("window_start"),
            (start + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
            "type",
            "nombre_mesures",
            "valeur_moyenne",
            "alertes",
        )
    )
