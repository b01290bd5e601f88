"""Reading summary: one row per (site, machine, type, day, hour), and
measures that work on either warehouse rows or summary rows.

Running every aggregate report straight off the table scans it once per
report.  Every aggregate report groups by a subset of (site, machine, type,
day, hour), and all its measures can be merged from per-group partials:
count, exact DECIMAL sum and sum of squares, min, max, alert count, latest
time.  So ``reading_summary`` scans the table once (partial aggregation
before the shuffle), and the reports roll that small table up.  The
summary's size depends on sites x machines x types x hours, not on the
number of readings.

Measures from the summary equal the ones from the rows: counts, min, max and
latest time exactly; averages exactly (DECIMAL sums, HALF_UP rounding), and
the sample standard deviation from the same sums, subtracted in DECIMAL, so a
small deviation around a large mean keeps its digits.  Groups with values from
``EXACT_BELOW`` on, or whose sums leave the DECIMAL range, use sums in DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions import avg_half_up, round_half_up
from sensorlake.functions.rounding import EXACT_BELOW, exact

SUMMARY_KEYS = ("site", "machine", "type", "year", "month", "day", "hour")

N, NV, SUM, SUMSQ, DSUM, DSUMSQ, VMIN, VMAX, ALERTS, LAST = (
    "_n", "_nv", "_sum", "_sumsq", "_dsum", "_dsumsq", "_min", "_max", "_alerts", "_last",
)
SUM_DECIMAL = "decimal(38,6)"
SUMSQ_DECIMAL = "decimal(38,12)"


def reading_summary(df: DataFrame) -> DataFrame:
    """Warehouse rows -> one row per (site, machine, type, year, month, day, hour)."""
    v = exact(F.col("value"))
    return df.groupBy(*SUMMARY_KEYS).agg(
        F.count(F.lit(1)).alias(N),
        F.count("value").alias(NV),
        F.try_sum(v).cast(SUM_DECIMAL).alias(SUM),
        F.try_sum(v * v).try_cast(SUMSQ_DECIMAL).alias(SUMSQ),
        F.sum("value").alias(DSUM),
        F.sum(F.col("value") * F.col("value")).alias(DSUMSQ),
        F.min("value").alias(VMIN),
        F.max("value").alias(VMAX),
        F.count_if(F.col("is_alert")).alias(ALERTS),
        F.max("timestamp").alias(LAST),
    )


def is_summary(df: DataFrame) -> bool:
    return N in df.columns and SUM in df.columns


class Measures:
    """Aggregate expressions for ``df``, whether it holds readings or a summary."""

    def __init__(self, df: DataFrame):
        self.summary = is_summary(df)

    def count(self) -> Column:
        return F.sum(N).cast("bigint") if self.summary else F.count(F.lit(1))

    def alerts(self) -> Column:
        return F.sum(ALERTS).cast("bigint") if self.summary else F.count_if(F.col("is_alert"))

    def avg(self, scale: int) -> Column:
        if not self.summary:
            return avg_half_up("value", scale)
        # decimal(28,6) / bigint keeps 16 fraction digits before the rounding
        mean = F.try_divide(F.try_sum(SUM).try_cast("decimal(28,6)"), F.sum(NV))
        plain = F.round(F.sum(DSUM) / F.sum(NV), scale)
        return F.when(self._exact(), F.coalesce(F.round(mean, scale).cast("double"), plain)).otherwise(plain)

    def _exact(self) -> Column:
        """Whether the decimal sums hold every value of the group."""
        return (F.max(F.greatest(F.abs(VMIN), F.abs(VMAX))) < EXACT_BELOW) & (F.count(SUM) == F.count_if(F.col(NV) > 0))

    def min(self, scale: int) -> Column:
        return round_half_up(F.min(VMIN if self.summary else "value"), scale)

    def max(self, scale: int) -> Column:
        return round_half_up(F.max(VMAX if self.summary else "value"), scale)

    def last(self) -> Column:
        return F.max(LAST if self.summary else "timestamp")

    def std(self, scale: int) -> Column:
        if not self.summary:
            return F.round(F.stddev_samp("value"), scale)
        n = F.sum(NV)
        total = F.try_sum(SUM).try_cast("decimal(38,6)")
        mean_part = F.try_divide(F.try_multiply(total, total), n)
        parts = F.try_subtract(F.try_sum(SUMSQ), mean_part).cast("double")
        plain = F.sum(DSUMSQ) - F.sum(DSUM) * F.sum(DSUM) / n
        whole = self._exact() & (F.count(SUMSQ) == F.count(SUM))
        var = F.when(whole, F.coalesce(parts, plain)).otherwise(plain) / (n - 1)
        return F.round(F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0)))), scale)


def merge_summaries(*summaries: DataFrame) -> DataFrame:
    """One summary from several (e.g. the table's so far and a new batch's)."""
    union = summaries[0]
    for s in summaries[1:]:
        union = union.unionByName(s)
    return union.groupBy(*SUMMARY_KEYS).agg(
        F.sum(N).cast("bigint").alias(N),
        F.sum(NV).cast("bigint").alias(NV),
        # NULL where a part has no exact sum, as a sum would pass over it
        F.when(F.count(SUM) == F.count_if(F.col(NV) > 0), F.try_sum(SUM).try_cast(SUM_DECIMAL)).alias(SUM),
        F.when(F.count(SUMSQ) == F.count_if(F.col(NV) > 0), F.try_sum(SUMSQ).try_cast(SUMSQ_DECIMAL)).alias(SUMSQ),
        F.sum(DSUM).alias(DSUM),
        F.sum(DSUMSQ).alias(DSUMSQ),
        F.min(VMIN).alias(VMIN),
        F.max(VMAX).alias(VMAX),
        F.sum(ALERTS).cast("bigint").alias(ALERTS),
        F.max(LAST).alias(LAST),
    )
