"""De-duplication of readings.

One identity everywhere, in a batch, against the table and whatever the sizes:
a reading is its ``sensor_id`` within its table partition (site, type, day).
Rows that repeat a reading with the same content are repeats and are dropped;
rows that repeat it with other content are conflicts: the earliest time stays,
then the smallest content, and the others go to the quarantine.

Exact repeats collapse in a partial (map-side) hash aggregate, so a reading
repeated across a third of the input never meets in one task; only the rows of
identities that still occur twice are sorted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake import model

KEY = "sensor_id"
IDENTITY = (KEY, *model.PARTITION_COLUMNS)
#: What a reading says besides its identity.
CONTENT = ("timestamp", "value", "unit", "machine")


@dataclass(frozen=True)
class PartitionProfile:
    """Rows per touched table partition: ``(site, type, year, month, day, n)``.

    The driver holds one entry per touched partition, as the commit of the
    write to those partitions does anyway."""

    rows: list

    @property
    def total(self) -> int:
        return sum(r[5] for r in self.rows)

    @property
    def empty(self) -> bool:
        return not self.rows

    @property
    def partitions(self) -> list[tuple]:
        return [tuple(r[:5]) for r in self.rows]


def partition_profile(batch: DataFrame) -> PartitionProfile:
    """One job: row count per (site, type, year, month, day) of ``batch``."""
    return PartitionProfile([tuple(r) for r in batch.groupBy(*model.PARTITION_COLUMNS).count().collect()])


#: What becomes of a reading of a batch: it is appended, the table or the batch has it word for word, or it contradicts one of them.
STATUS = "_status"
NEW, REPEATED, CONFLICTING = "new", "repeated", "conflicting"


def decide(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The distinct readings (identity and content) of ``rows`` with their ``STATUS``, in one pass over both sides.

    Batch and table rows that say the same collapse in a hash aggregate before anything is sorted; what is left of an
    identity is ranked in one window, the table's rows first.  A reading that the table holds is repeated; another one
    of an identity that the table holds is conflicting; of the others the first by content is new."""
    keys = [*IDENTITY, *CONTENT]
    rest = [c for c in rows.columns if c not in keys]
    both = rows.select(*keys, *rest, F.lit(1).alias("_side"))
    if existing is not None:
        held = existing.select(*keys, *(F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rest), F.lit(0).alias("_side"))
        both = both.unionByName(held)
    once = both.groupBy(*keys).agg(*[F.min(c).alias(c) for c in rest], F.min("_side").alias("_first"), F.max("_side").alias("_last"))
    by_identity = Window.partitionBy(*IDENTITY)
    ranked = once.withColumns(
        {"_held": F.min("_first").over(by_identity) == 0, "_rank": F.row_number().over(by_identity.orderBy("_first", *CONTENT))}
    )
    status = (
        F.when(F.col("_first") == 0, REPEATED).when(F.col("_held") | (F.col("_rank") > 1), CONFLICTING).otherwise(NEW)
    )
    return ranked.filter("_last = 1").select(*rows.columns, status.alias(STATUS))


def dedup_stream(df: DataFrame, delay: str = "1 day", event_time: str = "timestamp") -> DataFrame:
    """Streaming X1 with Spark's state: drop a reading seen before, within the watermark delay.

    Spark's operator also drops what lies further behind the newest time than
    ``delay``; ``plans.ingest.merge_late`` adds those rows from the landed files.
    """
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(IDENTITY))
