"""Views kept incrementally per micro-batch: the latest readings (R4), the
reading summary that the BI exports roll up (R5, X2) and the alerts (R6).

A view's state is written as versions, ``<number>-<stream>-<batch>``, and a
version counts once its marker exists (made after the write).  The number is
the view's own, so a new checkpoint goes on where the old one stopped; a
batch that has its marker is skipped, so a replay changes nothing.  Readers
take the newest finished version and never meet a file that is being written.

The summary has its versions and their markers in a folder per day: a trigger
lists, reads and writes the days that its rows touch, and no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.operators import reports
from sensorlake.operators.summary import merge_summaries, reading_summary
from sensorlake.session import list_names, remove_path, touch
from sensorlake.sources.json_files import path_exists

LATEST_SCHEMA = (
    "sensor_id string, type string, value double, site string, machine string, "
    "timestamp timestamp, is_alert boolean, ingestion_timestamp timestamp"
)
DAY = "_day"


def stream_id(checkpoint: str) -> str:
    """Short stable name of a stream: its checkpoint."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


@dataclass(frozen=True)
class Version:
    """``number`` orders the versions of a view; (``stream``, ``batch``) is what made it."""

    number: int
    stream: str
    batch: int

    @property
    def name(self) -> str:
        return f"{self.number:012d}-{self.stream}-{self.batch}"

    @classmethod
    def of(cls, name: str) -> Version:
        number, stream, batch = name.split("-")
        return cls(int(number), stream, int(batch))


def finished(spark: SparkSession, path: str) -> list[Version]:
    """Versions whose markers exist, oldest first."""
    return sorted((Version.of(n) for n in list_names(spark, f"{path}/_finished")), key=lambda v: v.number)


def next_version(spark: SparkSession, path: str, stream: str, batch_id: int) -> Version | None:
    """The version that the batch is to write; None if it is there already."""
    done = finished(spark, path)
    if any((v.stream, v.batch) == (stream, batch_id) for v in done):
        return None
    return Version(max((v.number for v in done), default=0) + 1, stream, batch_id)


def finish(spark: SparkSession, path: str, version: Version) -> None:
    touch(spark, f"{path}/_finished/{version.name}")


#: Versions kept for readers in flight, beside the newest.
KEPT = 1


def _latest_order():
    return F.desc("ingestion_timestamp"), F.desc("timestamp"), F.asc("sensor_id")


def update_latest(new_rows: DataFrame, path: str, stream: str, batch_id: int, n: int = 10) -> None:
    """Keep the ``n`` most recent readings: top-n of the previous ones and the new
    rows (which the table did not hold), O(batch) and never a scan of the table."""
    spark = new_rows.sparkSession
    version = next_version(spark, path, stream, batch_id)
    if version is None:
        return
    cols = [c.split()[0] for c in LATEST_SCHEMA.split(", ")]
    merged = new_rows.select(*cols)
    before = finished(spark, path)
    if before:
        merged = merged.unionByName(spark.read.schema(LATEST_SCHEMA).parquet(f"{path}/v={before[-1].name}"))
    merged.orderBy(*_latest_order()).limit(n).write.mode("overwrite").parquet(f"{path}/v={version.name}")
    finish(spark, path, version)
    for old in before[: -KEPT]:
        remove_path(spark, f"{path}/v={old.name}")
        remove_path(spark, f"{path}/_finished/{old.name}")


def read_latest(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """The published latest readings, formatted as A16 (status label, rounding)."""
    done = finished(spark, path)
    if not done:
        return reports.latest_readings(spark.createDataFrame([], LATEST_SCHEMA), n)
    return reports.latest_readings(spark.read.schema(LATEST_SCHEMA).parquet(f"{path}/v={done[-1].name}"), n)


DONE = "_done-"


def _day_versions(spark: SparkSession, path: str, day: str) -> list[Version]:
    """Finished versions of a day, oldest first: those whose markers lie beside them."""
    names = [n.removeprefix(DONE) for n in list_names(spark, f"{path}/{DAY}={day}") if n.startswith(DONE)]
    return sorted((Version.of(n) for n in names), key=lambda v: v.number)


def update_summary(new_rows: DataFrame, path: str, stream: str, batch_id: int) -> list[str]:
    """Merge the summary of a batch's new rows into the kept one; returns the days rewritten (a day that has the batch
    already is left alone, so a replay goes on where it was broken off)."""
    spark = new_rows.sparkSession
    day = F.make_date("year", "month", "day").cast("string")
    held = {r[0]: _day_versions(spark, path, r[0]) for r in new_rows.select(day).distinct().collect()}
    held = {d: vs for d, vs in held.items() if not any((v.stream, v.batch) == (stream, batch_id) for v in vs)}
    if not held:
        return []
    version = Version(1 + max((vs[-1].number for vs in held.values() if vs), default=0), stream, batch_id)
    merged = reading_summary(new_rows.filter(day.isin(*held)))
    dirs = [f"{path}/{DAY}={d}/v={vs[-1].name}" for d, vs in held.items() if vs]
    if dirs:
        merged = merge_summaries(spark.read.schema(merged.schema).parquet(*dirs), merged)
    writer = merged.withColumns({DAY: day, "v": F.lit(version.name)}).repartition(DAY, "site", "type").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(DAY, "v").parquet(path)
    for d, vs in held.items():
        touch(spark, f"{path}/{DAY}={d}/{DONE}{version.name}")
        for old in vs[: -KEPT]:
            remove_path(spark, f"{path}/{DAY}={d}/{DONE}{old.name}")
            remove_path(spark, f"{path}/{DAY}={d}/v={old.name}")
    return sorted(held)


def read_summary(spark: SparkSession, path: str) -> DataFrame | None:
    """The kept reading summary (None before the first batch with a row)."""
    dirs = []
    for d in list_names(spark, path):
        if d.startswith(f"{DAY}="):
            dirs += [f"{path}/{d}/v={v.name}" for v in _day_versions(spark, path, d.removeprefix(f"{DAY}="))[-1:]]
    return spark.read.parquet(*dirs) if dirs else None


@dataclass(frozen=True)
class Steps:
    """Markers of a batch's steps, so that a replayed batch repeats none of those that ended."""

    spark: SparkSession
    path: str
    batch_id: int

    def once(self, name: str, step: Callable[[], None]) -> None:
        marker = f"{self.path}/{self.batch_id}/{name}"
        if not path_exists(self.spark, marker):
            step()
            touch(self.spark, marker)

    def forget_older(self) -> None:
        """Only the last batch can be replayed; the markers of earlier ones go."""
        for n in list_names(self.spark, self.path):
            if n.isdigit() and int(n) < self.batch_id:
                remove_path(self.spark, f"{self.path}/{n}")
