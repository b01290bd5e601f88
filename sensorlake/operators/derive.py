"""Derived warehouse columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake import model
from sensorlake.functions import alert_flag, parse_timestamp

EVENT_TIME = "event_time"
#: Time of ingestion where rows are staged, so that all that reads them has one stamp.
STAMP = "ingestion_timestamp"


def with_event_time(df: DataFrame, out: str = EVENT_TIME) -> DataFrame:
    """T1 + T2: the parsed reading time next to its text (NULL if unreadable)."""
    return df.withColumn(out, parse_timestamp(F.col("timestamp")))


def with_calendar(df: DataFrame, time_col: str = EVENT_TIME) -> DataFrame:
    """T3 + T4: calendar parts of the parsed time and the alert flag."""
    t = F.col(time_col)
    return df.withColumns(
        {
            "year": F.year(t),
            "month": F.month(t),
            "day": F.dayofmonth(t),
            "hour": F.hour(t),
            "is_alert": alert_flag("type", "value"),
        }
    )


def warehouse_columns(df: DataFrame, time_col: str = EVENT_TIME, ingestion_time: bool = True) -> DataFrame:
    """C7 + C8 + T5: rows with a readable time, in warehouse column order."""
    stamp = F.current_timestamp() if ingestion_time else F.lit(None).cast("timestamp")
    if ingestion_time and STAMP in df.columns:
        stamp = F.col(STAMP)
    return (
        df.filter(F.col(time_col).isNotNull())
        .withColumn("timestamp", F.col(time_col))
        .withColumn("ingestion_timestamp", stamp)
        .select(*model.WAREHOUSE_COLUMNS)
    )


def derive(df: DataFrame, ingestion_time: bool = True) -> DataFrame:
    """Validated raw readings -> warehouse rows (time parsed once)."""
    return warehouse_columns(with_calendar(with_event_time(df)), ingestion_time=ingestion_time)


def to_warehouse(raw: DataFrame) -> DataFrame:
    """normalise -> validate -> derive, the whole batch/stream transform chain."""
    from sensorlake.operators.cleaning import normalise, validate

    return derive(validate(normalise(raw)))
