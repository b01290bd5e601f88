"""Normalise and validate raw readings.

The union of the sensor types (C3) is the one scan that reads all their
directories (``sources.json_files.read_sensor_dirs``).

All functions work on batch and streaming DataFrames alike, so the batch
and the streaming ingestion apply exactly the same rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake import model


def normalise(df: DataFrame) -> DataFrame:
    """C1 + C2: ``type`` lower(trim); ids, places and time text trimmed; value as double.

    Blank strings (after trim) become NULL so that validation rejects them
    and a blank ``site`` never reaches the partitioned write.
    """

    def blank_to_null(c: Column) -> Column:
        return F.when(c != F.lit(""), c)

    out = {}
    for name in ("sensor_id", "site", "machine", "timestamp"):
        if name in df.columns:
            out[name] = blank_to_null(F.trim(F.col(name)))
    if "type" in df.columns:
        out["type"] = blank_to_null(F.lower(F.trim(F.col("type"))))
    if "value" in df.columns:
        value_type = dict(df.dtypes)["value"]
        if value_type != "double":
            out["value"] = F.col("value").try_cast("double")
    return df.withColumns(out)


def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def rejection_checks(
    df: DataFrame, include_time: bool = False, parsed_time: str | None = None
) -> list[tuple[str, Column]]:
    """(reason, failing-condition) pairs, in a fixed order.

    ``include_time`` adds the unreadable-time check, which ``derive`` applies
    anyway after parsing (C7); it is listed for rejection reports.  Pass
    ``parsed_time`` (a column already holding the parsed time) to reuse it.
    """
    checks: list[tuple[str, Column]] = []
    if _has(df, model.CORRUPT_COLUMN):
        checks.append(("corrupt_record", F.col(model.CORRUPT_COLUMN).isNotNull()))
    for name in model.REQUIRED_COLUMNS:
        checks.append((f"{name}_missing", F.col(name).isNull()))
    types = [F.lit(t) for t in model.SENSOR_TYPES]
    checks.append(("unknown_type", F.col("type").isNotNull() & ~F.col("type").isin(*types)))
    checks.append(("nan_value", F.isnan(F.col("value"))))
    checks.append(("infinite_value", F.abs("value") == F.lit(float("inf"))))
    checks.append(("negative_value", F.col("value") < F.lit(0.0)))
    if include_time or parsed_time:
        from sensorlake.functions import parse_timestamp

        ts = F.col("timestamp")
        parsed = F.col(parsed_time) if parsed_time else parse_timestamp(ts)
        checks.append(("timestamp_unreadable", ts.isNotNull() & parsed.isNull()))
    return checks


def valid_condition(df: DataFrame) -> Column:
    """C4 + C5: a row is valid iff no check fails (NULL-safe)."""
    failing = [F.coalesce(cond, F.lit(False)) for _, cond in rejection_checks(df)]
    return ~reduce(lambda a, b: a | b, failing)


def validate(df: DataFrame) -> DataFrame:
    """Keep valid rows only."""
    return df.filter(valid_condition(df))


def with_reject_reasons(df: DataFrame, column: str = "reject_reasons", parsed_time: str | None = None) -> DataFrame:
    """Q6: add an array of every failing reason (empty for valid rows)."""
    checks = rejection_checks(df, include_time=True, parsed_time=parsed_time)
    reasons = [F.when(F.coalesce(cond, F.lit(False)), F.lit(reason)) for reason, cond in checks]
    return df.withColumn(column, F.array_compact(F.array(*reasons)))
