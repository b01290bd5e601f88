"""Decision reports and BI extracts (A1-A19) over the warehouse table.

Each report is a plain function ``warehouse DataFrame -> DataFrame``; the
caller decides whether to show, collect or write it (``sensorlake.sinks``).
Output column names are the reference's.  Every report is a filter +
hash aggregate (partial aggregation before the shuffle, so a hot key is
combined map-side) or a top-k; filters on ``type`` prune warehouse
partitions, and only the referenced columns are read.

Day and hour groupings use the stored ``year, month, day`` (partition
values, constant per file) and ``hour`` columns; the ``yyyy-MM-dd`` text is
formatted once per group after the aggregation, not once per row.

Aggregate reports accept either warehouse rows or the reading summary
(``sensorlake.operators.summary``): their measures come from ``Measures``,
so running many reports over one summary scans the table once.
``SUMMARY_REPORTS`` lists them; row-level extracts need the rows.

Orders carry tie-breakers so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.functions import alert_flag, pct_half_up, round_half_up, status_label
from sensorlake.operators.summary import Measures

DAY_FORMAT = "yyyy-MM-dd"


DAY_KEYS = ("year", "month", "day")


def _day_text() -> F.Column:
    """``yyyy-MM-dd`` of an aggregated (year, month, day) group."""
    return F.date_format(F.make_date("year", "month", "day"), DAY_FORMAT).alias("date")


def _of_type(df: DataFrame, sensor_type: str) -> DataFrame:
    return df.filter(F.col("type") == F.lit(sensor_type))


# --- A1 family: temperature ------------------------------------------------


def temperature_by_machine_day(df: DataFrame) -> DataFrame:
    """A1: mean / min / max temperature per site, machine and day."""
    m = Measures(df)
    return (
        _of_type(df, "temperature")
        .groupBy("site", "machine", *DAY_KEYS)
        .agg(
            m.avg(2).alias("temperature_moyenne"),
            m.min(2).alias("temperature_min"),
            m.max(2).alias("temperature_max"),
            m.count().alias("nombre_mesures"),
        )
        .select("site", "machine", _day_text(), "temperature_moyenne", "temperature_min",
                "temperature_max", "nombre_mesures")
        .orderBy("site", "machine", "date")
    )


def temperature_by_machine_day_documented(df: DataFrame) -> DataFrame:
    """Documented form, mean and count only."""
    return temperature_by_machine_day(df).select(
        "site", "machine", "date", "temperature_moyenne", "nombre_mesures"
    )


def temperature_by_machine(df: DataFrame) -> DataFrame:
    """Per site and machine, all days together."""
    m = Measures(df)
    return (
        _of_type(df, "temperature")
        .groupBy("site", "machine")
        .agg(
            m.avg(2).alias("temp_moyenne"),
            m.min(2).alias("temp_min"),
            m.max(2).alias("temp_max"),
            m.count().alias("nb_mesures"),
        )
        .orderBy("site", "machine")
    )


# --- A2 family: alerts per type ----------------------------------------------


def alerts_by_type(df: DataFrame) -> DataFrame:
    """A2: alerts recomputed from the thresholds (not the stored flag)."""
    m = Measures(df)
    return (
        df.groupBy("type")
        .agg(
            m.count().alias("total_mesures"),
            F.count_if(alert_flag("type", "value")).alias("alertes_critiques"),
        )
        .orderBy(F.desc("alertes_critiques"), "type")
    )


def alerts_by_type_pct(df: DataFrame) -> DataFrame:
    """Stored flag, with the alert percentage."""
    m = Measures(df)
    return (
        df.groupBy(F.col("type").alias("type_capteur"))
        .agg(m.count().alias("total_mesures"), m.alerts().alias("alertes_critiques"))
        .withColumn("pourcentage", pct_half_up("alertes_critiques", "total_mesures", 2))
        .orderBy(F.desc("alertes_critiques"), "type_capteur")
    )


# --- A3 family: vibration variability (top 5) -------------------------------


def vibration_top5(df: DataFrame, min_count: int = 10, k: int = 5) -> DataFrame:
    """A3: highest sample standard deviation of vibration per machine."""
    m = Measures(df)
    return (
        _of_type(df, "vibration")
        .groupBy("site", "machine")
        .agg(
            m.count().alias("nombre_mesures"),
            m.std(3).alias("ecart_type"),
            m.min(3).alias("min_val"),
            m.max(3).alias("max_val"),
        )
        .filter(F.col("nombre_mesures") >= F.lit(min_count))
        .orderBy(F.desc_nulls_last("ecart_type"), "site", "machine")
        .limit(k)
    )


def vibration_top5_all(df: DataFrame, min_count: int = 0, k: int = 5) -> DataFrame:
    """Documented form with the mean, no minimum count."""
    m = Measures(df)
    return (
        _of_type(df, "vibration")
        .groupBy("machine", "site")
        .agg(
            m.std(3).alias("ecart_type"),
            m.avg(3).alias("moyenne"),
            m.count().alias("mesures"),
        )
        .filter(F.col("mesures") >= F.lit(min_count))
        .orderBy(F.desc_nulls_last("ecart_type"), "site", "machine")
        .limit(k)
    )


# --- A4 family: hourly pressure ----------------------------------------------


def pressure_hourly(df: DataFrame) -> DataFrame:
    """A4: mean pressure per site and hour of day (all days merged)."""
    m = Measures(df)
    return (
        _of_type(df, "pressure")
        .groupBy("site", F.col("hour").alias("heure"))
        .agg(m.avg(2).alias("pression_moyenne"), m.count().alias("nombre_mesures"))
        .orderBy("site", "heure")
    )


def pressure_hourly_std(df: DataFrame) -> DataFrame:
    """Per site and hour with the standard deviation (the reference's
    pandas variant and its column names)."""
    m = Measures(df)
    return (
        _of_type(df, "pressure")
        .groupBy("site", "hour")
        .agg(
            m.avg(2).alias("pression_moyenne"),
            m.std(2).alias("ecart_type"),
            m.count().alias("nb_mesures"),
        )
        .orderBy("site", "hour")
    )


# --- BI extracts -------------------------------------------------------------

# The columns of the extract, in order.
RAW_EXPORT_COLUMNS = (
    "sensor_id", "type", "value", "unit", "site", "machine",
    "timestamp", "year", "month", "day", "hour", "is_alert",
)


def raw_export(df: DataFrame) -> DataFrame:
    """The 12 reading columns, oldest first.

    The global sort is range-partitioned on (timestamp, sensor_id): the
    unique second key lets the range split a hot timestamp.
    """
    return df.select(*RAW_EXPORT_COLUMNS).orderBy("timestamp", "sensor_id")


def raw_export_desc(df: DataFrame, with_ingestion_time: bool = True) -> DataFrame:
    """13 columns (with ``ingestion_timestamp``), newest first."""
    cols = list(RAW_EXPORT_COLUMNS) + (["ingestion_timestamp"] if with_ingestion_time else [])
    return df.select(*cols).orderBy(F.desc("timestamp"), "sensor_id")


def _group_measures(m: Measures, avg_name: str = "valeur_moyenne", alerts_name: str = "alertes"):
    return [
        m.count().alias("total_mesures"),
        m.avg(2).alias(avg_name),
        m.alerts().alias(alerts_name),
        m.last().alias("derniere_mesure"),
    ]


def stats_by_type(df: DataFrame) -> DataFrame:
    """Every aggregate kind per sensor type."""
    m = Measures(df)
    return (
        df.groupBy("type")
        .agg(
            m.count().alias("total_mesures"),
            m.avg(2).alias("valeur_moyenne"),
            m.min(2).alias("valeur_min"),
            m.max(2).alias("valeur_max"),
            m.std(2).alias("ecart_type"),
            m.alerts().alias("nombre_alertes"),
            m.last().alias("derniere_mesure"),
        )
        .orderBy("type")
    )


def stats_by_site(df: DataFrame) -> DataFrame:
    """Per site and type."""
    return df.groupBy("site", "type").agg(*_group_measures(Measures(df))).orderBy("site", "type")


def stats_by_machine(df: DataFrame) -> DataFrame:
    """A10: per site, machine and type."""
    return (
        df.groupBy("site", "machine", "type")
        .agg(*_group_measures(Measures(df)))
        .orderBy("site", "machine", "type")
    )


def hourly_trends(df: DataFrame) -> DataFrame:
    """Per day, hour of day and type."""
    m = Measures(df)
    return (
        df.groupBy(*DAY_KEYS, F.col("hour").alias("heure"), "type")
        .agg(
            m.count().alias("nombre_mesures"),
            m.avg(2).alias("valeur_moyenne"),
            m.alerts().alias("alertes"),
        )
        .select(_day_text(), "heure", "type", "nombre_mesures", "valeur_moyenne", "alertes")
        .orderBy("date", "heure", "type")
    )


def critical_alerts(df: DataFrame, with_ingestion_time: bool = True) -> DataFrame:
    """Every alert reading, newest first."""
    cols = ["sensor_id", "type", "value", "unit", "site", "machine", "timestamp"]
    if with_ingestion_time:
        cols.append("ingestion_timestamp")
    return df.filter(F.col("is_alert")).select(*cols).orderBy(F.desc("timestamp"), "sensor_id")


def dashboard_summary(df: DataFrame, with_export_time: bool = True) -> DataFrame:
    """One row of key figures.

    Two-level aggregate instead of three COUNT(DISTINCT)s over the whole
    table: the first level is a partial-aggregated group-by on
    (site, machine), whose output is tiny; the distinct counts run on it.
    ``nombre_machines`` counts machine names (as the reference does);
    ``nombre_machines_site`` counts (site, machine) pairs.
    """
    m = Measures(df)
    per_machine = df.groupBy("site", "machine").agg(
        m.count().alias("n"),
        m.alerts().alias("a"),
        m.last().alias("t"),
    )
    pair = F.col("site").isNotNull() & F.col("machine").isNotNull()
    out = per_machine.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_mesures"),
        F.count_distinct("site").alias("nombre_sites"),
        F.count_distinct("machine").alias("nombre_machines"),
        F.count_if(pair).alias("nombre_machines_site"),
        F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("total_alertes"),
        F.max("t").alias("derniere_mise_a_jour"),
    )
    out = out.withColumn("taux_alerte_pct", pct_half_up("total_alertes", "total_mesures", 2))
    cols = [
        "total_mesures", "nombre_sites", "nombre_machines", "nombre_machines_site",
        "total_alertes", "taux_alerte_pct", "derniere_mise_a_jour",
    ]
    if with_export_time:
        out = out.withColumn("export_timestamp", F.current_timestamp())
        cols.append("export_timestamp")
    return out.select(*cols)


# --- live monitor --------------------------------------------------------------


def monitor_stats(df: DataFrame) -> DataFrame:
    """Per-type figures shown by the live monitor."""
    m = Measures(df)
    return (
        df.groupBy("type")
        .agg(
            m.count().alias("count"),
            m.avg(2).alias("avg_value"),
            m.min(2).alias("min_value"),
            m.max(2).alias("max_value"),
            m.alerts().alias("alerts"),
        )
        .orderBy("type")
    )


def latest_readings(df: DataFrame, n: int = 10, by_ingestion_time: bool = True) -> DataFrame:
    """The ``n`` most recent readings with a status label (a top-k).

    Newest ingestion first, then newest reading time, then ``sensor_id``.
    """
    order = ([F.desc("ingestion_timestamp")] if by_ingestion_time else []) + [
        F.desc("timestamp"),
        F.asc("sensor_id"),
    ]
    return (
        df.orderBy(*order)
        .limit(n)
        .select(
            "type",
            "site",
            "machine",
            round_half_up("value", 2).alias("value"),
            status_label("is_alert").alias("status"),
            "timestamp",
        )
    )


def warehouse_stats(df: DataFrame) -> DataFrame:
    """Total, per type and per site; the grouping sets expand the (type, site) groups, not the rows."""
    m = Measures(df)
    groups = df.groupBy("type", "site").agg(m.count().alias("n"), m.alerts().alias("a"))
    grouped = groups.groupingSets([[], ["type"], ["site"]], "type", "site").agg(
        F.grouping_id().alias("_gid"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_mesures"),
        F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("alertes"),
    )
    # grouping_id bits: type -> 2, site -> 1 (1 = aggregated away)
    level = (
        F.when(F.col("_gid") == 3, F.lit("total"))
        .when(F.col("_gid") == 1, F.lit("type"))
        .otherwise(F.lit("site"))
    )
    return (
        grouped.withColumn("level", level)
        .select("level", "type", "site", "total_mesures", "alertes")
        .orderBy("level", "type", "site")
    )


def value_summary(df: DataFrame) -> DataFrame:
    """Count / mean / std / min / max per type, 2 decimals, plus alerts."""
    m = Measures(df)
    return (
        df.groupBy("type")
        .agg(
            m.count().alias("count"),
            m.avg(2).alias("mean"),
            m.std(2).alias("std"),
            m.min(2).alias("min"),
            m.max(2).alias("max"),
            m.alerts().alias("alerts"),
        )
        .orderBy("type")
    )


# --- registry (A5) ----------------------------------------------------------------

# The names under which the reports and the exports are written.
DECISION_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "temperature_moyenne": temperature_by_machine_day,
    "alertes_critiques": alerts_by_type,
    "top5_variabilite_vibration": vibration_top5,
    "evolution_pression_horaire": pressure_hourly,
}

BI_EXPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "raw_data": raw_export_desc,
    "stats_by_type": stats_by_type,
    "stats_by_site": stats_by_site,
    "stats_by_machine": stats_by_machine,
    "hourly_trends": hourly_trends,
    "critical_alerts": critical_alerts,
    "dashboard_summary": dashboard_summary,
}


# Reports whose measures roll up from the reading summary (see module docs);
# the others need the rows (row-level extracts, thresholds re-applied).
SUMMARY_REPORTS = frozenset(
    {
        temperature_by_machine_day, temperature_by_machine_day_documented, temperature_by_machine,
        alerts_by_type_pct, vibration_top5, vibration_top5_all, pressure_hourly, pressure_hourly_std,
        stats_by_type, stats_by_site, stats_by_machine, hourly_trends, dashboard_summary,
        monitor_stats, warehouse_stats, value_summary,
    }
)


def run_all(df: DataFrame, registry: dict[str, Callable[[DataFrame], DataFrame]] = DECISION_REPORTS) -> dict[str, DataFrame]:
    """A5: every report of a registry over one snapshot (lazy DataFrames)."""
    return {name: fn(df) for name, fn in registry.items()}
