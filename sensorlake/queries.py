"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator,
and the equivalent DuckDB SQL used as the correctness oracle.

Output timestamps are returned as ``timestamp_ntz`` (wall clock), the type
of the test data and of DuckDB's ``TIMESTAMP``.  Ingestion / export times
(``current_timestamp()``) are left out of compared outputs: they are not
reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake import model
from sensorlake.functions import parse_timestamp
from sensorlake.operators import quality, reports
from sensorlake.operators.dedup import dedup_stream
from sensorlake.operators.derive import to_warehouse
from sensorlake.plans.exports import export_all, run_reports
from sensorlake.plans.ingest import ingest_batch, ingest_frame, merge_late
from sensorlake.session import bounded_state, remove_path, scratch_path
from sensorlake.sinks.csv import export_single_csv, write_csv
from sensorlake.sources.events import STREAM_FILES, land_arrays, land_damaged, land_readings, land_texts, raw_readings, read_table, time_text_variants, warehouse_rows
from sensorlake.sources.json_files import infer_schema, read_sensor_dirs, sensor_dirs
from sensorlake.sources.ledger import read_ledger
from sensorlake.sources.warehouse import read_csv_warehouse, read_warehouse, register_view
from sensorlake.streaming import ingest as stream_ingest
from sensorlake.streaming import monitor, windows
from sensorlake.streaming.latest import read_summary

Query = Callable[[SparkSession, str], DataFrame]


def ntz(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP column to TIMESTAMP_NTZ (same wall clock)."""
    cols = [
        df[f.name].cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else df[f.name]
        for f in df.schema.fields
    ]
    return df.select(*cols)


def _report(fn: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ntz(fn(warehouse_rows(spark, sf_dir)))

    run.__name__ = getattr(fn, "__name__", "report")
    run.__doc__ = fn.__doc__
    return run


def registry() -> dict[str, Query]:
    out: dict[str, Query] = {
        "temperature_by_machine_day": _report(reports.temperature_by_machine_day),
        "temperature_by_machine_day_documented": _report(reports.temperature_by_machine_day_documented),
        "temperature_by_machine": _report(reports.temperature_by_machine),
        "alerts_by_type": _report(reports.alerts_by_type),
        "alerts_by_type_pct": _report(reports.alerts_by_type_pct),
        "vibration_top5": _report(reports.vibration_top5),
        "vibration_top5_all": _report(reports.vibration_top5_all),
        "pressure_hourly": _report(reports.pressure_hourly),
        "pressure_hourly_std": _report(reports.pressure_hourly_std),
        "raw_export": _report(reports.raw_export),
        "raw_export_desc": _report(lambda df: reports.raw_export_desc(df, with_ingestion_time=False)),
        "stats_by_type": _report(reports.stats_by_type),
        "stats_by_site": _report(reports.stats_by_site),
        "stats_by_machine": _report(reports.stats_by_machine),
        "hourly_trends": _report(reports.hourly_trends),
        "critical_alerts": _report(lambda df: reports.critical_alerts(df, with_ingestion_time=False)),
        "dashboard_summary": _report(lambda df: reports.dashboard_summary(df, with_export_time=False)),
        "monitor_stats": _report(reports.monitor_stats),
        "latest_readings": _report(reports.latest_readings),
        "warehouse_stats": _report(reports.warehouse_stats),
        "value_summary": _report(reports.value_summary),
        "timestamp_parse": timestamp_parse,
        "ingest_batch": ingest_batch_query,
        "ingest_rerun": ingest_rerun,
        "quarantine": quarantine,
        "null_profile": null_profile,
        "reject_reasons": reject_reasons,
        "valid_by_type": valid_by_type,
        "schema_drift": schema_drift,
        "field_drift": field_drift,
        "ingest_stream": ingest_stream,
        "stream_batch_metrics": stream_batch_metrics,
        "stream_dedup": stream_dedup,
        "stream_hourly": stream_hourly,
        "stream_alerts": stream_alerts,
        "stream_stats_by_type": stream_stats_by_type,
        "ingest_stream_state": ingest_stream_state,
        "stream_summary_stats": stream_summary_stats,
        "stream_raw_archive": stream_raw_archive,
        "compaction": compaction,
        "ingest_batch_multiline": ingest_batch_multiline,
        "ingest_stream_multiline": ingest_stream_multiline,
        "ingest_salvage": ingest_salvage,
        "ingest_salvage_stream": ingest_salvage_stream,
        "ingest_typed_recovery": ingest_typed_recovery,
        "ingest_ledger": ingest_ledger,
        "ingest_overwrite": ingest_overwrite,
        "ingest_two_sites": ingest_two_sites,
        "ingest_two_sites_one_batch": ingest_two_sites_one_batch,
        "run_summary": run_summary,
        "large_values": large_values,
        "export_all": export_all_query,
        "run_reports": run_reports_query,
        "export_values": export_values,
        "single_csv": single_csv,
        "csv_warehouse": csv_warehouse,
        "export_refresh": export_refresh,
        "export_refresh_all": export_refresh_all,
        "stream_windows": stream_windows,
        "bom_check": bom_check,
        "sql_view": sql_view,
    }
    return out


# ---------------------------------------------------------------------------
# Ingestion, quality and streaming queries.  Each lands the readings derived
# from ``events`` as line-delimited JSON files in a fresh folder under the
# session's checkpoint directory, runs the operator on the files, and
# returns a read of what it wrote.
# ---------------------------------------------------------------------------

WAREHOUSE_OUT = list(reports.RAW_EXPORT_COLUMNS)


def _landing(spark: SparkSession, sf_dir: str, defects: bool = False, copies: int = 1) -> str:
    """Readings as JSON files, every one ``copies`` times; with ``defects``, 'signup'
    readings carry their value as a JSON string (corrupt records)."""
    root = scratch_path(spark, "landing")
    bad = (F.col("type") == F.lit("signup")) if defects else None
    for _ in range(copies):
        land_readings(raw_readings(spark, sf_dir), root, value_as_text=bad)
    return root


def _landed_raw(spark: SparkSession, sf_dir: str, defects: bool = True) -> DataFrame:
    return read_sensor_dirs(spark, _landing(spark, sf_dir, defects), multi_line=False)


def _forget(spark: SparkSession, *paths: str) -> None:
    """Scratch that the result does not read goes at once."""
    for path in paths:
        remove_path(spark, path)


def _table(spark: SparkSession, path: str) -> DataFrame:
    return ntz(read_warehouse(spark, path).select(*WAREHOUSE_OUT))


def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T2: every ``events.ts`` written in one of thirteen text forms, parsed back; null where words stand
    before or behind it, or a half of the day."""
    ev = read_table(spark, sf_dir, "events")
    text = time_text_variants(F.col("ts"), F.col("event_id"))
    text = (
        F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("at "), text))
        .when(F.col("event_id") % 89 == 0, F.date_format("ts", "yyyy-MM-dd hh:mm a"))
        .when(F.col("event_id") % 83 == 0, F.concat(text, F.lit(" broken")))
        .when(F.col("event_id") % 79 == 0, F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" PST")))
        .otherwise(text)
    )
    return ev.select(
        F.col("event_id").cast("string").alias("sensor_id"),
        parse_timestamp(text).cast("timestamp_ntz").alias("timestamp"),
    )


def ingest_batch_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: JSON files -> validated, de-duplicated, partitioned warehouse."""
    root = _landing(spark, sf_dir)
    wh = scratch_path(spark, "warehouse")
    ingest_batch(spark, root, wh, multi_line=False)
    _forget(spark, root)
    return _table(spark, wh)


def ingest_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ingests of the same files, the last with every file twice;
    the table holds each reading once."""
    root, copy = _landing(spark, sf_dir), _landing(spark, sf_dir)
    wh = scratch_path(spark, "warehouse")
    ingest_batch(spark, root, wh, multi_line=False)
    ingest_batch(spark, root, wh, multi_line=False)
    ingest_batch(spark, None, wh, multi_line=False, paths=sensor_dirs(spark, root) + sensor_dirs(spark, copy))
    _forget(spark, root, copy)
    return _table(spark, wh)


def _moved(readings: DataFrame) -> DataFrame:
    """The same readings, ids included, as if another site had sent them."""
    return readings.withColumn("site", F.concat(F.lit("Moved_"), F.col("site")))


def ingest_two_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that occur at two sites, in two batches: a reading is its id within its partition."""
    wh = scratch_path(spark, "warehouse")
    readings = raw_readings(spark, sf_dir)
    ingest_frame(readings, wh)
    ingest_frame(_moved(readings), wh)
    return _table(spark, wh)


def ingest_two_sites_one_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in one batch."""
    wh = scratch_path(spark, "warehouse")
    readings = raw_readings(spark, sf_dir)
    ingest_frame(readings.unionByName(_moved(readings)), wh)
    return _table(spark, wh)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of an ingest with repeats and conflicts: every reading twice, every tenth also with another value."""
    wh, qu = scratch_path(spark, "warehouse"), scratch_path(spark, "quarantine")
    readings = raw_readings(spark, sf_dir)
    other = readings.filter(F.col("sensor_id").cast("long") % 10 == 0).withColumn("value", F.col("value") + 1000)
    report = ingest_frame(readings.unionByName(readings).unionByName(other), wh, quarantine_path=qu)
    kept = spark.read.parquet(qu).agg(F.sum("occurrences").alias("in_quarantine"))
    _forget(spark, wh)
    return report.frame(spark).join(kept)


def ingest_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 overwrite: an ingest of moved readings is replaced; an overwrite without a valid row changes nothing."""
    wh = scratch_path(spark, "warehouse")
    readings = raw_readings(spark, sf_dir)
    ingest_frame(_moved(readings), wh)
    ingest_frame(readings, wh, mode="overwrite")
    ingest_frame(readings.withColumn("type", F.lit("unknown")), wh, mode="overwrite")
    return _table(spark, wh)


def ingest_batch_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 as the sensors write: one pretty-printed JSON value per file."""
    root, wh = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    land_arrays(raw_readings(spark, sf_dir), root)
    ingest_batch(spark, root, wh, glob="part-*", multi_line=True)
    _forget(spark, root)
    return _table(spark, wh)


def ingest_stream_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 as the sensors write: one pretty-printed JSON value per file, some files a batch."""
    root, wh = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    land_arrays(raw_readings(spark, sf_dir), root, per_file=20_000, most=STREAM_FILES)
    _stream(spark, root, wh, glob="part-*", multi_line=True, max_files_per_trigger=4)
    _forget(spark, root)
    return _table(spark, wh)


def _salvaged(spark: SparkSession, wh: str, qu: str) -> DataFrame:
    """What became of every reading that was landed: stored, or corrupt, with its place; and the stray words."""
    corrupt = spark.read.parquet(qu).filter(F.col(model.CORRUPT_COLUMN).isNotNull())
    ids = lambda pattern, outcome: corrupt.select(
        F.explode(F.regexp_extract_all(model.CORRUPT_COLUMN, F.lit(pattern))).alias("sensor_id"),
        F.lit(outcome).alias("outcome"),
        F.lit(None).cast("double").alias("value"),
        F.col(model.SOURCE_PLACE_COLUMN).isNotNull().alias("placed"),
    )
    stored = read_warehouse(spark, wh).select("sensor_id", F.lit("stored").alias("outcome"), "value", F.lit(False).alias("placed"))
    return stored.unionByName(ids('"sensor_id":"([0-9]+)"', "corrupt")).unionByName(ids("junk([0-9]+)", "junk"))


def ingest_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of many readings in four layouts, some of them damaged: the others of a file are stored."""
    root, wh, qu = (scratch_path(spark, n) for n in ("landing", "warehouse", "quarantine"))
    land_damaged(raw_readings(spark, sf_dir), root)
    ingest_batch(spark, root, wh, quarantine_path=qu, glob="part-*", multi_line=True)
    _forget(spark, root)
    return _salvaged(spark, wh, qu)


def ingest_salvage_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in a stream, some files a batch."""
    root, wh, qu = (scratch_path(spark, n) for n in ("landing", "warehouse", "quarantine"))
    land_damaged(raw_readings(spark, sf_dir), root, per_file=5_000, most=STREAM_FILES)
    _stream(spark, root, wh, glob="part-*", multi_line=True, max_files_per_trigger=4, quarantine_path=qu)
    _forget(spark, root)
    return _salvaged(spark, wh, qu)


def ingest_typed_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading of three sends its value as text, one of seven an object as its value."""
    root, wh, qu = (scratch_path(spark, n) for n in ("landing", "warehouse", "quarantine"))
    readings = raw_readings(spark, sf_dir)
    number = F.col("sensor_id").cast("long")
    land_readings(readings.filter(number % 7 != 0), root, value_as_text=number % 3 == 0)
    land_readings(readings.filter(number % 7 == 0).withColumn("value", F.struct(F.col("value").alias("is"))), root)
    ingest_batch(spark, root, wh, quarantine_path=qu, multi_line=False, typed_recovery=True)
    _forget(spark, root)
    corrupt = spark.read.parquet(qu).filter(F.col(model.CORRUPT_COLUMN).isNotNull())
    stored = read_warehouse(spark, wh).select("sensor_id", "value", F.lit("stored").alias("outcome"))
    return stored.unionByName(corrupt.select("sensor_id", F.lit(None).cast("double").alias("value"), F.array_join("reject_reasons", ",").alias("outcome")))


def ingest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs with a ledger, the second over the same files, the third after more have landed: rows read and
    written in each, and files that were read twice."""
    root, wh, ledger = (scratch_path(spark, n) for n in ("landing", "warehouse", "ledger"))
    readings = raw_readings(spark, sf_dir)
    third = F.col("sensor_id").cast("long") % 3 == 0
    runs = []
    for k, part in enumerate((~third, None, third)):
        if part is not None:
            land_readings(readings.filter(part), root)
        report = ingest_batch(spark, root, wh, multi_line=False, ledger_path=ledger)
        runs.append((k + 1, report.total, report.written))
    _forget(spark, root)
    twice = read_ledger(spark, ledger).groupBy("path").count().filter("count > 1").agg(F.count(F.lit(1)).alias("files_read_twice"))
    noted = read_ledger(spark, ledger).agg(F.sum("rows").alias("rows_noted"))
    return spark.createDataFrame(runs, "run long, total long, written long").join(twice).join(noted)


def large_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports over readings of 1e13, beyond the exact range; infinite ones are rejected."""
    big = F.when(F.col("sensor_id").cast("long") % 100 == 0, F.lit(1e13)).when(F.col("sensor_id").cast("long") % 101 == 0, F.lit(float("inf")))
    rows = to_warehouse(raw_readings(spark, sf_dir).withColumn("value", F.coalesce(big, "value")))
    rough = [F.round(c, -4).alias(c) for c in ("valeur_moyenne", "ecart_type")]  # of 1e10 and more
    return reports.stats_by_type(rows).select("type", "total_mesures", "valeur_min", "valeur_max", "nombre_alertes", *rough)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 + quarantine sink: rejected and corrupt rows, with their reasons; every file twice."""
    root = _landing(spark, sf_dir, defects=True, copies=2)
    wh, qu = scratch_path(spark, "warehouse"), scratch_path(spark, "quarantine")
    ingest_batch(spark, root, wh, quarantine_path=qu, multi_line=False)
    ingest_batch(spark, root, wh, quarantine_path=qu, multi_line=False)  # re-run adds nothing
    _forget(spark, root, wh)
    return (
        spark.read.parquet(qu)
        .groupBy("sensor_id", "type", "site", "machine", F.array_join("reject_reasons", ",").alias("reasons"), F.col(model.CORRUPT_COLUMN).isNotNull().alias("corrupt"))
        .agg(F.sum("occurrences").alias("occurrences"))
    )


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 on the JSON files (with corrupt records)."""
    return quality.null_profile(_landed_raw(spark, sf_dir))


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 on the JSON files (with corrupt records)."""
    return quality.reject_reason_counts(_landed_raw(spark, sf_dir))


def valid_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 on the JSON files (with corrupt records)."""
    from sensorlake.operators.cleaning import normalise

    return quality.valid_by_type(normalise(_landed_raw(spark, sf_dir)))


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: per sensor type, the schema inferred from its files against the declared one."""
    root = _landing(spark, sf_dir, defects=True)
    inferred = {d.rsplit("/", 1)[1]: infer_schema(spark, d, multi_line=False) for d in sensor_dirs(spark, root)}
    _forget(spark, root)
    return quality.schema_drift(spark, model.RAW_SCHEMA, inferred)


def field_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 by field and kind, in one pass over the files: values sent as text, and a field that only some readings have."""
    root = scratch_path(spark, "landing")
    readings = raw_readings(spark, sf_dir)
    newer = F.when(F.col("sensor_id").cast("long") % 5 == 0, F.lit(2))
    land_readings(readings.withColumn("firmware", newer), root, value_as_text=F.col("type") == "signup")
    found = quality.field_drift(quality.reading_texts(spark, sensor_dirs(spark, root)))
    return found.groupBy("column_name", "issue", "declared_type", "found_type").agg(
        F.sum("readings").alias("readings"), F.count_if(F.col("first_file").isNull()).alias("without_file")
    )


def bom_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: landing files with a byte-order mark (one of each type is landed beside the others), and files that do not
    begin with a reading."""
    root = _landing(spark, sf_dir)
    first = raw_readings(spark, sf_dir).filter(F.col("type").isin(*model.SENSOR_TYPES)).groupBy(F.col("type").alias("_dir")).agg(F.min("sensor_id").alias("sensor_id"))
    land_texts(first.select("_dir", F.concat(F.lit("\ufeff"), F.to_json(F.struct("sensor_id"))).alias("value")), root)
    files = quality.bom_check(spark, sensor_dirs(spark, root), glob="part-*")
    starts = F.startswith(F.col("head"), F.lit('{"sensor_id":"'))
    return files.agg(F.count_if("has_bom").alias("with_bom"), F.count_if((F.col("length") > 0) & ~starts).alias("other_start"))


def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report in SQL over the registered view."""
    register_view(warehouse_rows(spark, sf_dir), "sensor_data")
    return spark.sql("SELECT site, type, count(*) AS total, count_if(is_alert) AS alertes FROM sensor_data GROUP BY site, type")


def _held_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The warehouse rows, derived once and kept as scratch for the many reads of them, and their path.  They are dealt out
    first: ``events`` may have few row groups, and parsing the times takes longest."""
    path = scratch_path(spark, "rows")
    dealt = raw_readings(spark, sf_dir).repartition(3 * spark.sparkContext.defaultParallelism)
    to_warehouse(dealt).write.parquet(path)
    return spark.read.schema(model.WAREHOUSE_SCHEMA).parquet(path), path


def export_all_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All BI exports written as CSV and read back: rows, and the sum of their counts or alerts."""
    out = scratch_path(spark, "exports")
    rows, held = _held_rows(spark, sf_dir)
    export_all(rows, out)
    _forget(spark, held)
    return _read_back(spark, {n: f"{out}/{n}" if n in ("raw_data", "critical_alerts") else f"{out}/{n}.csv" for n in reports.BI_EXPORTS})


def run_reports_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5, K3, K6: the decision reports written as CSV and read back."""
    rows, held = _held_rows(spark, sf_dir)
    paths = run_reports(rows, scratch_path(spark, "reports"))
    _forget(spark, held)
    return _read_back(spark, paths)


def _read_back(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    out = None
    for name, path in paths.items():
        df = spark.read.option("header", True).csv(path)
        number = next((c for c in ("total_mesures", "nombre_mesures") if c in df.columns), None)
        total = F.coalesce(F.sum(F.col(number).cast("bigint")), F.lit(0)) if number else F.count(F.lit(1))
        part = df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), total.cast("bigint").alias("readings"))
        out = part if out is None else out.unionByName(part)
    return out


#: Written report or export -> the query of the same report, and its numbers.
EXPORTED = {
    "temperature_moyenne": ("temperature_by_machine_day", ("temperature_moyenne", "temperature_min", "temperature_max", "nombre_mesures")),
    "alertes_critiques": ("alerts_by_type", ("total_mesures", "alertes_critiques")),
    "top5_variabilite_vibration": ("vibration_top5", ("nombre_mesures", "ecart_type", "min_val", "max_val")),
    "evolution_pression_horaire": ("pressure_hourly", ("heure", "pression_moyenne", "nombre_mesures")),
    "raw_data": ("raw_export", ("value", "day", "hour")),
    "stats_by_type": ("stats_by_type", ("total_mesures", "valeur_moyenne", "valeur_min", "valeur_max", "ecart_type", "nombre_alertes")),
    "stats_by_site": ("stats_by_site", ("total_mesures", "valeur_moyenne", "alertes")),
    "stats_by_machine": ("stats_by_machine", ("total_mesures", "valeur_moyenne", "alertes")),
    "hourly_trends": ("hourly_trends", ("heure", "nombre_mesures", "valeur_moyenne", "alertes")),
    "critical_alerts": ("critical_alerts", ("value",)),
    "dashboard_summary": ("dashboard_summary", ("total_mesures", "nombre_sites", "nombre_machines", "total_alertes", "taux_alerte_pct")),
}


def export_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report and export written as CSV and read back: the sum of each of its columns of numbers."""
    out = scratch_path(spark, "exports")
    rows, held = _held_rows(spark, sf_dir)
    export_all(rows, out)
    paths = run_reports(rows, scratch_path(spark, "reports"))
    _forget(spark, held)
    paths |= {n: f"{out}/{n}" if n in ("raw_data", "critical_alerts") else f"{out}/{n}.csv" for n in reports.BI_EXPORTS}
    found = None
    for name, (_, columns) in EXPORTED.items():
        read = spark.read.option("header", True).csv(paths[name])
        sums = read.agg(*[F.round(F.sum(F.col(c).cast("decimal(38,6)")), 3).cast("double").alias(c) for c in columns])
        part = sums.unpivot([], list(columns), "column_name", "total").select(F.lit(name).alias("name"), "column_name", "total")
        found = part if found is None else found.unionByName(part)
    return found


_SITE_STATS = "site string, type string, total_mesures bigint, valeur_moyenne double, alertes bigint, derniere_mesure timestamp"
_TYPE_STATS = (
    "type string, total_mesures bigint, valeur_moyenne double, valeur_min double, valeur_max double, "
    "ecart_type double, nombre_alertes bigint, derniere_mesure timestamp"
)


def single_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: a report as one named CSV file, read back."""
    path = export_single_csv(reports.stats_by_site(warehouse_rows(spark, sf_dir)), scratch_path(spark, "csv"), "stats_by_site")
    return ntz(spark.read.schema(_SITE_STATS).option("header", True).csv(path))


def csv_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + S10: the warehouse as CSV, read back."""
    path = write_csv(warehouse_rows(spark, sf_dir), scratch_path(spark, "csv-warehouse"))
    return ntz(read_csv_warehouse(spark, path).select(*WAREHOUSE_OUT))


def export_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports rebuilt after every micro-batch from the kept summary, read back."""
    root = _landing(spark, sf_dir, copies=2)
    wh, out, kept = (scratch_path(spark, n) for n in ("warehouse", "exports", "summary"))
    _stream(spark, root, wh, summary_path=kept, on_batch=monitor.export_refresher(wh, out, summary_path=kept))
    _forget(spark, root, wh, kept)
    return ntz(spark.read.schema(_TYPE_STATS).option("header", True).csv(f"{out}/stats_by_type.csv"))


def export_refresh_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven exports after a stream (every file twice, one a batch): the aggregates rebuilt, the row extracts appended to."""
    root = _landing(spark, sf_dir, copies=2)
    wh, out, kept = (scratch_path(spark, n) for n in ("warehouse", "exports", "summary"))
    _stream(spark, root, wh, summary_path=kept, row_exports_path=out, on_batch=monitor.export_refresher(wh, out, summary_path=kept))
    _forget(spark, root, wh, kept)
    return _read_back(spark, {n: f"{out}/{n}" if n in ("raw_data", "critical_alerts") else f"{out}/{n}.csv" for n in reports.BI_EXPORTS})


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time windows as the stream's own state, one file per batch, with no recomputation."""
    root = _landing(spark, sf_dir)
    out, ckpt = scratch_path(spark, "windows"), scratch_path(spark, "ckpt")
    _run(windows.start_windows(spark, root, out, ckpt, multi_line=False, available_now=True, max_files_per_trigger=1, fold=3))
    _forget(spark, root, ckpt)
    return ntz(windows.read_windows(spark, out))


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _stream(spark: SparkSession, root: str, wh: str, multi_line: bool = False, max_files_per_trigger: int | None = 1, **options) -> None:
    """The streaming ingestion of all landed files, by default one file per batch."""
    ckpt = scratch_path(spark, "ckpt")
    _run(stream_ingest.start_ingest(
        spark, root, wh, ckpt, available_now=True, multi_line=multi_line, max_files_per_trigger=max_files_per_trigger, **options
    ))
    _forget(spark, ckpt)


def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files through the streaming ingestion (one file per batch)."""
    root, wh = _landing(spark, sf_dir), scratch_path(spark, "warehouse")
    _stream(spark, root, wh)
    _forget(spark, root)
    return _table(spark, wh)


def stream_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch metrics of both modes (every file twice), summed over batches."""
    out = None
    for mode in ("table", "state"):
        root = _landing(spark, sf_dir, defects=True, copies=2)
        wh, metrics = scratch_path(spark, "warehouse"), scratch_path(spark, "metrics")
        # In state mode all files in one batch: the counts behind the watermark are merge_late's.
        _stream(spark, root, wh, metrics_path=metrics, dedup=mode, max_files_per_trigger=2 if mode == "table" else None)
        _forget(spark, root, wh)
        names = ("rows_read", "rows_valid", "rows_rejected", "rows_written", "alerts")
        part = spark.read.parquet(metrics).agg(F.lit(mode).alias("mode"), *[F.sum(c).cast("bigint").alias(c) for c in names])
        out = part if out is None else out.unionByName(part)
    return out


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 streaming: every file twice, one file per batch, in whatever order; the rows that Spark's state lets pass.
    The delay spans all readings, so no row of the stream's own is late."""
    root = _landing(spark, sf_dir, copies=2)
    out, ckpt = scratch_path(spark, "dedup"), scratch_path(spark, "ckpt")
    raw = stream_ingest.readings_stream(spark, root, max_files_per_trigger=1, multi_line=False)
    rows = dedup_stream(to_warehouse(raw).drop("ingestion_timestamp"), delay="3650 days")
    with bounded_state(spark):
        query = rows.writeStream.format("parquet").option("checkpointLocation", ckpt).option("path", out).trigger(availableNow=True).start()
    _run(query)
    _forget(spark, root, ckpt)
    return ntz(spark.read.parquet(out).select(*WAREHOUSE_OUT))


def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time hourly windows per type from the kept summary; every file twice, one file per batch."""
    root = _landing(spark, sf_dir, copies=2)
    wh, kept = scratch_path(spark, "warehouse"), scratch_path(spark, "summary")
    _stream(spark, root, wh, summary_path=kept)
    _forget(spark, root, wh)
    return ntz(monitor.hourly_windows(read_summary(spark, kept)))


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts as they come; every file twice, one file per batch."""
    root = _landing(spark, sf_dir, copies=2)
    wh, out = scratch_path(spark, "warehouse"), scratch_path(spark, "alerts")
    _stream(spark, root, wh, alerts_path=out)
    _forget(spark, root, wh)
    return ntz(stream_ingest.read_alerts(spark, out).select(*WAREHOUSE_OUT))


def ingest_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 with in-stream de-dup (``dedup="state"``): every file twice, one file per
    batch; a batch adds what lay behind the watermark."""
    root, wh = _landing(spark, sf_dir, copies=2), scratch_path(spark, "warehouse")
    _stream(spark, root, wh, dedup="state")
    merge_late(spark, root, wh, multi_line=False)
    _forget(spark, root)
    return _table(spark, wh)


def stream_summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 path: per-type statistics (A8) rolled up from the reading summary a
    stream keeps current (every file twice, one file per micro-batch)."""
    root = _landing(spark, sf_dir, copies=2)
    wh, kept = scratch_path(spark, "warehouse"), scratch_path(spark, "summary")
    _stream(spark, root, wh, summary_path=kept)
    _forget(spark, root, wh)
    return ntz(reports.stats_by_type(read_summary(spark, kept)))


def stream_raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 (re-aimed): raw copy of every landed reading, as Parquet, unvalidated."""
    root = _landing(spark, sf_dir)
    out, ckpt = scratch_path(spark, "archive"), scratch_path(spark, "ckpt")
    _run(stream_ingest.start_raw_archive(spark, root, out, ckpt, available_now=True, multi_line=False, max_files_per_trigger=1))
    _forget(spark, root, ckpt)
    return spark.read.parquet(out).select(*[c for c, _ in model.RAW_FIELDS])


def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small-file compaction of the days a stream wrote (one file per micro-batch)."""
    from sensorlake.sinks.warehouse import compact

    root, wh = _landing(spark, sf_dir), scratch_path(spark, "warehouse")
    _stream(spark, root, wh)
    compact(spark, wh, days=read_warehouse(spark, wh).select("year", "month", "day"))
    _forget(spark, root)
    return _table(spark, wh)


def stream_stats_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live per-type figures, published after every batch; every file twice, one file per batch."""
    root = _landing(spark, sf_dir, copies=2)
    wh, kept, newest, out = (scratch_path(spark, n) for n in ("warehouse", "summary", "latest", "monitor"))
    publish = monitor.monitor_publisher(wh, out, summary_path=kept, latest_path=newest)
    _stream(spark, root, wh, summary_path=kept, latest_path=newest, on_batch=publish)
    _forget(spark, root, wh, kept, newest)
    return spark.read.parquet(f"{out}/stats").drop("batch_id")


# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------

# The adapter, validation and derivation written once in SQL.  Rounding:
# DuckDB rounds the binary double, Spark-side measures are exact HALF_UP in
# DECIMAL; ``+ 1e-9`` makes DuckDB round exact halves up as well.
RAW_CTE = """raw AS (
  SELECT CAST(event_id AS VARCHAR) AS sensor_id,
         CASE event_type WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'vibration'
              WHEN 'purchase' THEN 'pressure' ELSE event_type END AS type,
         CASE WHEN event_type IN ('view', 'purchase') THEN value / 10 ELSE value END AS value,
         CASE event_type WHEN 'click' THEN 'Celsius' WHEN 'view' THEN 'mm/s'
              WHEN 'purchase' THEN 'bar' END AS unit,
         'Site_' || CAST(user_id % 5 AS VARCHAR) AS site,
         'Machine_' || CAST((user_id // 5) % 5 AS VARCHAR) AS machine,
         date_trunc('millisecond', ts) AS timestamp
  FROM events
)"""

ALERT_SQL = """CASE WHEN type = 'temperature' AND (value < 0 OR value > 85) THEN TRUE
              WHEN type = 'vibration' AND (value < 0 OR value > 7.0) THEN TRUE
              WHEN type = 'pressure' AND (value < 0.5 OR value > 6.0) THEN TRUE
              ELSE FALSE END"""

SENSOR_DATA_CTE = f"""{RAW_CTE},
sensor_data AS (
  SELECT sensor_id, type, value, unit, site, machine, timestamp,
         CAST(year(timestamp) AS INTEGER) AS year, CAST(month(timestamp) AS INTEGER) AS month,
         CAST(day(timestamp) AS INTEGER) AS day, CAST(hour(timestamp) AS INTEGER) AS hour,
         {ALERT_SQL} AS is_alert
  FROM raw
  WHERE sensor_id IS NOT NULL AND type IN ('temperature', 'vibration', 'pressure')
    AND value IS NOT NULL AND NOT isnan(value) AND value >= 0
    AND site IS NOT NULL AND machine IS NOT NULL AND timestamp IS NOT NULL
)"""


WAREHOUSE_SQL = "sensor_id, type, value, unit, site, machine, timestamp, year, month, day, hour, is_alert"


def _w(body: str) -> str:
    return f"WITH {SENSOR_DATA_CTE}\n{body.strip()}"


R2 = "ROUND({} + 1e-9, 2)"
ALERTS = "COUNT(*) FILTER (WHERE is_alert)"
DATE = "strftime(timestamp, '%Y-%m-%d')"
HOUR = "CAST(hour(timestamp) AS INTEGER)"


def _pct(part: str, total: str) -> str:
    return f"ROUND(CAST({part} AS DOUBLE) * 100.0 / {total} + 1e-9, 2)"


def oracle_sql() -> dict[str, str]:
    out = {
        "temperature_by_machine_day": _w(f"""
SELECT site, machine, {DATE} AS date,
       ROUND(AVG(value) + 1e-9, 2) AS temperature_moyenne,
       ROUND(MIN(value) + 1e-9, 2) AS temperature_min,
       ROUND(MAX(value) + 1e-9, 2) AS temperature_max,
       COUNT(*) AS nombre_mesures
FROM sensor_data WHERE type = 'temperature'
GROUP BY site, machine, {DATE} ORDER BY site, machine, date"""),
        "temperature_by_machine_day_documented": _w(f"""
SELECT site, machine, {DATE} AS date,
       ROUND(AVG(value) + 1e-9, 2) AS temperature_moyenne,
       COUNT(*) AS nombre_mesures
FROM sensor_data WHERE type = 'temperature'
GROUP BY site, machine, {DATE} ORDER BY site, machine, date"""),
        "temperature_by_machine": _w("""
SELECT site, machine,
       ROUND(AVG(value) + 1e-9, 2) AS temp_moyenne,
       ROUND(MIN(value) + 1e-9, 2) AS temp_min,
       ROUND(MAX(value) + 1e-9, 2) AS temp_max,
       COUNT(*) AS nb_mesures
FROM sensor_data WHERE type = 'temperature'
GROUP BY site, machine ORDER BY site, machine"""),
        "alerts_by_type": _w(f"""
SELECT type, COUNT(*) AS total_mesures,
       COUNT(*) FILTER (WHERE {ALERT_SQL}) AS alertes_critiques
FROM sensor_data GROUP BY type ORDER BY alertes_critiques DESC, type"""),
        "alerts_by_type_pct": _w(f"""
SELECT type AS type_capteur, COUNT(*) AS total_mesures, {ALERTS} AS alertes_critiques,
       {_pct(ALERTS, 'COUNT(*)')} AS pourcentage
FROM sensor_data GROUP BY type ORDER BY alertes_critiques DESC, type_capteur"""),
        "vibration_top5": _w("""
SELECT site, machine, COUNT(*) AS nombre_mesures,
       ROUND(STDDEV_SAMP(value), 3) AS ecart_type,
       ROUND(MIN(value) + 1e-9, 3) AS min_val,
       ROUND(MAX(value) + 1e-9, 3) AS max_val
FROM sensor_data WHERE type = 'vibration'
GROUP BY site, machine HAVING COUNT(*) >= 10
ORDER BY ecart_type DESC NULLS LAST, site, machine LIMIT 5"""),
        "vibration_top5_all": _w("""
SELECT machine, site, ROUND(STDDEV_SAMP(value), 3) AS ecart_type,
       ROUND(AVG(value) + 1e-9, 3) AS moyenne, COUNT(*) AS mesures
FROM sensor_data WHERE type = 'vibration'
GROUP BY machine, site
ORDER BY ecart_type DESC NULLS LAST, site, machine LIMIT 5"""),
        "pressure_hourly": _w(f"""
SELECT site, {HOUR} AS heure, ROUND(AVG(value) + 1e-9, 2) AS pression_moyenne,
       COUNT(*) AS nombre_mesures
FROM sensor_data WHERE type = 'pressure'
GROUP BY site, {HOUR} ORDER BY site, heure"""),
        "pressure_hourly_std": _w(f"""
SELECT site, hour, ROUND(AVG(value) + 1e-9, 2) AS pression_moyenne,
       ROUND(STDDEV_SAMP(value), 2) AS ecart_type, COUNT(*) AS nb_mesures
FROM sensor_data WHERE type = 'pressure'
GROUP BY site, hour ORDER BY site, hour"""),
        "raw_export": _w("""
SELECT sensor_id, type, value, unit, site, machine, timestamp, year, month, day, hour, is_alert
FROM sensor_data ORDER BY timestamp, sensor_id"""),
        "raw_export_desc": _w("""
SELECT sensor_id, type, value, unit, site, machine, timestamp, year, month, day, hour, is_alert
FROM sensor_data ORDER BY timestamp DESC, sensor_id"""),
        "stats_by_type": _w(f"""
SELECT type, COUNT(*) AS total_mesures,
       ROUND(AVG(value) + 1e-9, 2) AS valeur_moyenne,
       ROUND(MIN(value) + 1e-9, 2) AS valeur_min,
       ROUND(MAX(value) + 1e-9, 2) AS valeur_max,
       ROUND(STDDEV_SAMP(value), 2) AS ecart_type,
       {ALERTS} AS nombre_alertes,
       MAX(timestamp) AS derniere_mesure
FROM sensor_data GROUP BY type ORDER BY type"""),
        "stats_by_site": _w(f"""
SELECT site, type, COUNT(*) AS total_mesures, ROUND(AVG(value) + 1e-9, 2) AS valeur_moyenne,
       {ALERTS} AS alertes, MAX(timestamp) AS derniere_mesure
FROM sensor_data GROUP BY site, type ORDER BY site, type"""),
        "stats_by_machine": _w(f"""
SELECT site, machine, type, COUNT(*) AS total_mesures,
       ROUND(AVG(value) + 1e-9, 2) AS valeur_moyenne,
       {ALERTS} AS alertes, MAX(timestamp) AS derniere_mesure
FROM sensor_data GROUP BY site, machine, type ORDER BY site, machine, type"""),
        "hourly_trends": _w(f"""
SELECT {DATE} AS date, {HOUR} AS heure, type, COUNT(*) AS nombre_mesures,
       ROUND(AVG(value) + 1e-9, 2) AS valeur_moyenne, {ALERTS} AS alertes
FROM sensor_data GROUP BY {DATE}, {HOUR}, type ORDER BY date, heure, type"""),
        "critical_alerts": _w("""
SELECT sensor_id, type, value, unit, site, machine, timestamp
FROM sensor_data WHERE is_alert ORDER BY timestamp DESC, sensor_id"""),
        "dashboard_summary": _w(f"""
SELECT COUNT(*) AS total_mesures, COUNT(DISTINCT site) AS nombre_sites,
       COUNT(DISTINCT machine) AS nombre_machines,
       COUNT(DISTINCT (site, machine)) AS nombre_machines_site,
       {ALERTS} AS total_alertes,
       {_pct(ALERTS, 'COUNT(*)')} AS taux_alerte_pct,
       MAX(timestamp) AS derniere_mise_a_jour
FROM sensor_data"""),
        "monitor_stats": _w(f"""
SELECT type, COUNT(*) AS "count", ROUND(AVG(value) + 1e-9, 2) AS avg_value,
       ROUND(MIN(value) + 1e-9, 2) AS min_value, ROUND(MAX(value) + 1e-9, 2) AS max_value,
       {ALERTS} AS alerts
FROM sensor_data GROUP BY type ORDER BY type"""),
        "latest_readings": _w("""
SELECT type, site, machine, ROUND(value + 1e-9, 2) AS value,
       CASE WHEN is_alert THEN '\U0001F6A8' ELSE '✅' END AS status, timestamp
FROM sensor_data ORDER BY timestamp DESC, sensor_id LIMIT 10"""),
        "warehouse_stats": _w(f"""
SELECT CASE WHEN GROUPING(type) = 1 AND GROUPING(site) = 1 THEN 'total'
            WHEN GROUPING(site) = 1 THEN 'type' ELSE 'site' END AS level,
       type, site, COUNT(*) AS total_mesures, {ALERTS} AS alertes
FROM sensor_data GROUP BY GROUPING SETS ((), (type), (site))"""),
        "value_summary": _w(f"""
SELECT type, COUNT(*) AS "count", ROUND(AVG(value) + 1e-9, 2) AS mean,
       ROUND(STDDEV_SAMP(value), 2) AS std, ROUND(MIN(value) + 1e-9, 2) AS "min",
       ROUND(MAX(value) + 1e-9, 2) AS "max", {ALERTS} AS alerts
FROM sensor_data GROUP BY type ORDER BY type"""),
        "timestamp_parse": """
SELECT CAST(event_id AS VARCHAR) AS sensor_id,
       CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0 OR event_id % 79 = 0 THEN NULL
            WHEN event_id % 13 IN (2, 3, 5, 11) THEN date_trunc('second', ts)
            WHEN event_id % 13 = 7 THEN date_trunc('minute', ts)
            ELSE date_trunc('millisecond', ts) END AS timestamp
FROM events""",
        "ingest_batch": _w(f"SELECT {WAREHOUSE_SQL} FROM sensor_data"),
        "ingest_rerun": _w(f"SELECT {WAREHOUSE_SQL} FROM sensor_data"),
        "quarantine": f"""WITH {RAW_CTE}
SELECT sensor_id, type, site, machine,
       CASE WHEN type = 'signup' THEN 'corrupt_record,value_missing,unknown_type'
            ELSE 'unknown_type' END AS reasons,
       type = 'signup' AS corrupt, 2 AS occurrences
FROM raw WHERE type NOT IN ('temperature', 'vibration', 'pressure')""",
        "null_profile": f"""WITH {RAW_CTE}, c AS (
  SELECT COUNT(*) FILTER (WHERE sensor_id IS NULL) AS sensor_id,
         COUNT(*) FILTER (WHERE type IS NULL) AS type,
         COUNT(*) FILTER (WHERE type = 'signup' OR value IS NULL) AS value,
         COUNT(*) FILTER (WHERE unit IS NULL) AS unit,
         COUNT(*) FILTER (WHERE site IS NULL) AS site,
         COUNT(*) FILTER (WHERE machine IS NULL) AS machine,
         COUNT(*) FILTER (WHERE timestamp IS NULL) AS timestamp,
         COUNT(*) FILTER (WHERE type <> 'signup') AS _corrupt_record
  FROM raw)
SELECT column_name, CAST(null_count AS BIGINT) AS null_count
FROM c UNPIVOT (null_count FOR column_name IN
  (sensor_id, type, value, unit, site, machine, timestamp, _corrupt_record))""",
        "reject_reasons": f"""WITH {RAW_CTE}
SELECT reason, COUNT(*) AS n FROM (
  SELECT 'corrupt_record' AS reason FROM raw WHERE type = 'signup'
  UNION ALL SELECT 'value_missing' FROM raw WHERE type = 'signup'
  UNION ALL SELECT 'unknown_type' FROM raw WHERE type NOT IN ('temperature', 'vibration', 'pressure')
) GROUP BY reason""",
        "valid_by_type": f"""WITH {RAW_CTE}
SELECT type, COUNT(*) AS total, COUNT(sensor_id) AS with_sensor_id,
       COUNT(*) FILTER (WHERE type IN ('temperature', 'vibration', 'pressure')) AS valid
FROM raw GROUP BY type""",
        "schema_drift": """
SELECT DISTINCT sensor_type, 'value' AS column_name, 'type_differs' AS issue,
       'double' AS declared_type, 'string' AS inferred_type
FROM events, (VALUES ('temperature'), ('vibration'), ('pressure')) t(sensor_type) WHERE event_type = 'signup'""",
        "ingest_stream": _w(f"SELECT {WAREHOUSE_SQL} FROM sensor_data"),
        "stream_batch_metrics": f"""WITH {SENSOR_DATA_CTE}
SELECT 'table' AS mode, 2 * (SELECT COUNT(*) FROM events) AS rows_read, 2 * COUNT(*) AS rows_valid,
       2 * ((SELECT COUNT(*) FROM events) - COUNT(*)) AS rows_rejected, COUNT(*) AS rows_written, {ALERTS} AS alerts
FROM sensor_data
UNION ALL
SELECT 'state', (SELECT 2 * COUNT(*) FROM events) - COUNT(*), COUNT(*),
       2 * ((SELECT COUNT(*) FROM events) - COUNT(*)), COUNT(*), {ALERTS}
FROM sensor_data""",
        "stream_dedup": _w(f"SELECT {WAREHOUSE_SQL} FROM sensor_data"),
        "stream_hourly": _w("""
SELECT date_trunc('hour', timestamp) AS window_start,
       date_trunc('hour', timestamp) + INTERVAL 1 HOUR AS window_end,
       type, COUNT(*) AS nombre_mesures, ROUND(AVG(value) + 1e-9, 2) AS valeur_moyenne,
       COUNT(*) FILTER (WHERE is_alert) AS alertes
FROM sensor_data GROUP BY 1, 2, type"""),
        "stream_alerts": _w(f"SELECT {WAREHOUSE_SQL} FROM sensor_data WHERE is_alert"),
        "stream_raw_archive": f"""WITH {RAW_CTE}
SELECT r.sensor_id, r.type, r.value, r.unit, r.site, r.machine,
       strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp
FROM raw r JOIN events e ON r.sensor_id = CAST(e.event_id AS VARCHAR)""",
        "compaction": _w(f"SELECT {WAREHOUSE_SQL} FROM sensor_data"),
        "ingest_stream_state": _w(f"SELECT {WAREHOUSE_SQL} FROM sensor_data"),
        "stream_stats_by_type": _w(f"""
SELECT type, COUNT(*) AS "count", ROUND(AVG(value) + 1e-9, 2) AS avg_value,
       ROUND(MIN(value) + 1e-9, 2) AS min_value, ROUND(MAX(value) + 1e-9, 2) AS max_value,
       {ALERTS} AS alerts
FROM sensor_data GROUP BY type"""),
    }
    out["stream_summary_stats"] = out["export_refresh"] = out["stats_by_type"]
    out["single_csv"] = out["stats_by_site"]
    for name in ("ingest_batch_multiline", "ingest_stream_multiline", "ingest_overwrite", "csv_warehouse"):
        out[name] = out["ingest_batch"]
    kind = "CAST(sensor_id AS BIGINT) % 10"
    out["ingest_salvage"] = out["ingest_salvage_stream"] = _w(f"""
SELECT sensor_id, 'stored' AS outcome, value, FALSE AS placed FROM sensor_data WHERE {kind} NOT IN (3, 7)
UNION ALL SELECT sensor_id, 'corrupt', NULL, TRUE FROM raw WHERE {kind} IN (3, 7)
UNION ALL SELECT sensor_id, 'junk', NULL, TRUE FROM raw WHERE {kind} = 9""")
    out["ingest_typed_recovery"] = _w("""
SELECT sensor_id, value, 'stored' AS outcome FROM sensor_data WHERE CAST(sensor_id AS BIGINT) % 7 <> 0
UNION ALL SELECT sensor_id, NULL, CASE WHEN type IN ('temperature', 'vibration', 'pressure') THEN 'corrupt_record,value_missing'
  ELSE 'corrupt_record,value_missing,unknown_type' END FROM raw WHERE CAST(sensor_id AS BIGINT) % 7 = 0""")
    third = "CAST(sensor_id AS BIGINT) % 3 = 0"
    out["ingest_ledger"] = _w(f"""
SELECT run, CASE run WHEN 1 THEN (SELECT COUNT(*) FROM raw WHERE NOT {third}) WHEN 2 THEN 0 ELSE (SELECT COUNT(*) FROM raw WHERE {third}) END AS total,
  CASE run WHEN 1 THEN (SELECT COUNT(*) FROM sensor_data WHERE NOT {third}) WHEN 2 THEN 0 ELSE (SELECT COUNT(*) FROM sensor_data WHERE {third}) END AS written,
  0 AS files_read_twice, (SELECT COUNT(*) FROM raw) AS rows_noted
FROM (VALUES (1), (2), (3)) t(run)""")
    out["ingest_two_sites"] = out["ingest_two_sites_one_batch"] = _w(f"""
SELECT {WAREHOUSE_SQL} FROM sensor_data
UNION ALL SELECT {WAREHOUSE_SQL.replace('site,', "'Moved_' || site,")} FROM sensor_data""")
    # Of a conflict the smaller value stays, as the time is the same.
    out["run_summary"] = _w(f"""
SELECT (SELECT COUNT(*) * 2 + COUNT(*) FILTER (WHERE CAST(sensor_id AS BIGINT) % 10 = 0) FROM raw) AS total,
       COUNT(*) * 2 + COUNT(*) FILTER (WHERE tenth) AS valid,
       (SELECT COUNT(*) * 2 + COUNT(*) FILTER (WHERE CAST(sensor_id AS BIGINT) % 10 = 0) FROM raw) - COUNT(*) * 2 - COUNT(*) FILTER (WHERE tenth) AS rejected,
       (SELECT COUNT(*) * 2 + COUNT(*) FILTER (WHERE CAST(sensor_id AS BIGINT) % 10 = 0) FROM raw) - COUNT(*) * 2 AS quarantined,
       (SELECT COUNT(*) * 2 + COUNT(*) FILTER (WHERE CAST(sensor_id AS BIGINT) % 10 = 0) FROM raw) - COUNT(*) * 2 AS in_quarantine,
       COUNT(*) FILTER (WHERE tenth) AS conflicting, COUNT(*) AS repeated, COUNT(*) AS written, {ALERTS} AS alerts
FROM (SELECT *, CAST(sensor_id AS BIGINT) % 10 = 0 AS tenth FROM sensor_data)""")
    big = "CASE WHEN CAST(sensor_id AS BIGINT) % 100 = 0 THEN 1e13 ELSE value END"
    out["large_values"] = _w(f"""
SELECT type, COUNT(*) AS total_mesures, ROUND(MIN(value) + 1e-9, 2) AS valeur_min, ROUND(MAX(value) + 1e-9, 2) AS valeur_max, {ALERTS} AS nombre_alertes,
  ROUND(AVG(value), -4) AS valeur_moyenne, ROUND(STDDEV_SAMP(value), -4) AS ecart_type
FROM (SELECT type, value, {ALERT_SQL} AS is_alert FROM (SELECT type, {big} AS value FROM sensor_data
      WHERE CAST(sensor_id AS BIGINT) % 100 = 0 OR CAST(sensor_id AS BIGINT) % 101 <> 0)) GROUP BY type""")
    total, alerts = "(SELECT COUNT(*) FROM sensor_data)", "(SELECT COUNT(*) FROM sensor_data WHERE is_alert)"
    groups = lambda keys: f"(SELECT COUNT(*) FROM (SELECT DISTINCT {keys} FROM sensor_data))"
    of = lambda t: f"(SELECT COUNT(*) FROM sensor_data WHERE type = '{t}')"
    out["export_all"] = _w(f"""
SELECT * FROM (VALUES ('raw_data', {total}, {total}), ('stats_by_type', {groups('type')}, {total}),
  ('stats_by_site', {groups('site, type')}, {total}), ('stats_by_machine', {groups('site, machine, type')}, {total}),
  ('hourly_trends', {groups('year, month, day, hour, type')}, {total}), ('critical_alerts', {alerts}, {alerts}),
  ('dashboard_summary', 1, {total})) t(name, rows, readings)""")
    out["run_reports"] = _w(f"""
SELECT * FROM (VALUES
  ('temperature_moyenne', (SELECT COUNT(*) FROM (SELECT DISTINCT site, machine, year, month, day FROM sensor_data WHERE type = 'temperature')), {of('temperature')}),
  ('alertes_critiques', {groups('type')}, {total}),
  ('top5_variabilite_vibration', (SELECT COUNT(*) FROM (SELECT site, machine FROM sensor_data WHERE type = 'vibration' GROUP BY site, machine HAVING COUNT(*) >= 10 LIMIT 5)),
   (SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM sensor_data WHERE type = 'vibration' GROUP BY site, machine HAVING COUNT(*) >= 10
      ORDER BY ROUND(STDDEV_SAMP(value), 3) DESC NULLS LAST, site, machine LIMIT 5))),
  ('evolution_pression_horaire', (SELECT COUNT(*) FROM (SELECT DISTINCT site, hour FROM sensor_data WHERE type = 'pressure')), {of('pressure')})
) t(name, rows, readings)""")
    out["export_refresh_all"], out["stream_windows"] = out["export_all"], out["stream_hourly"]
    out["field_drift"] = """
SELECT 'value' AS column_name, 'type_differs' AS issue, 'double' AS declared_type, 'STRING' AS found_type, COUNT(*) AS readings, 0 AS without_file
FROM events WHERE event_type = 'signup' HAVING COUNT(*) > 0
UNION ALL SELECT 'firmware', 'extra', NULL, 'BIGINT', COUNT(*), 0 FROM events WHERE event_id % 5 = 0 HAVING COUNT(*) > 0"""
    out["bom_check"] = _w("SELECT COUNT(DISTINCT type) AS with_bom, COUNT(DISTINCT type) AS other_start FROM raw WHERE type IN ('temperature', 'vibration', 'pressure')")
    out["export_values"] = "\nUNION ALL ".join(
        f"SELECT '{name}' AS name, '{c}' AS column_name, CAST(ROUND(SUM(CAST(\"{c}\" AS DECIMAL(38, 6))), 3) AS DOUBLE) AS total FROM ({out[report]})"
        for name, (report, columns) in EXPORTED.items()
        for c in columns
    )
    out["sql_view"] = _w(f"SELECT site, type, COUNT(*) AS total, {ALERTS} AS alertes FROM sensor_data GROUP BY site, type")
    return out
