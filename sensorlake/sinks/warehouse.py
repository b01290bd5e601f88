"""Partitioned warehouse table writes (K1, K2) and the quarantine table.

Layout: ``site / type / year / month / day`` (Parquet by default; the
format is a parameter so ``delta`` works where its package is installed).

Writers are range-partitioned on ``(site, type, year, month, day,
sensor_id)``; their number comes from the batch's partition profile
(``writer_count``).  Range boundaries come from a sample of the keys, so
every writer gets about the same number of rows; each writer holds a
contiguous run of table partitions (few files per directory); and the
unique ``sensor_id`` tail lets a hot table partition (one site-day holding
a third of all rows) be split across many writers instead of one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import model
from sensorlake.operators.dedup import CONFLICTING, NEW, STATUS, PartitionProfile, decide, partition_profile
from sensorlake.session import observation, remove_path, rename, touch
from sensorlake.sources.json_files import path_exists
from sensorlake.sources.warehouse import FILE_FORMATS, NEXT, OLD, SWAP, read_partitions, table_exists


@dataclass
class WriteResult:
    written: int
    alerts: int


# Target rows per written file (a few tens of MB of Parquet per writer).
ROWS_PER_WRITER = 2_000_000


def writer_count(spark, profile: PartitionProfile) -> int:
    """Writers for a batch: as many as ``ROWS_PER_WRITER`` rows each need, and
    at least one per core while there are table partitions to spread (small
    batches stay parallel without one tiny file per core)."""
    by_rows = -(-profile.total // ROWS_PER_WRITER)
    spread = min(spark.sparkContext.defaultParallelism, len(profile.rows))
    return max(1, by_rows, spread)


def _for_writers(df: DataFrame, writers: int) -> DataFrame:
    """Range-partition rows for the writers (at most as many partitions as
    distinct sampled keys, so a tiny batch never gets empty writer tasks)."""
    keys = [*model.PARTITION_COLUMNS, "sensor_id"]
    return df.select(*model.WAREHOUSE_COLUMNS).repartitionByRange(writers, *keys)


def write_warehouse(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet", writers: int | None = None) -> WriteResult:
    """K1: partitioned write (``append`` or whole-table ``overwrite``); an empty
    input writes nothing and removes nothing.

    An overwrite writes the new table beside the old one and moves it into its
    place once it is complete (``finish_overwrite``).

    Rows written and alerts among them are observed on the write itself.
    """
    if writers is None:
        profile = partition_profile(df)
        if profile.empty:
            return WriteResult(0, 0)
        writers = writer_count(df.sparkSession, profile)
    spark, obs = df.sparkSession, observation("warehouse_write")
    out = _for_writers(df, writers).observe(obs, F.count(F.lit(1)).alias("written"), F.count_if(F.col("is_alert")).alias("alerts"))
    writer = out.write.format(fmt).partitionBy(*model.PARTITION_COLUMNS)
    if fmt not in FILE_FORMATS:
        writer.mode(mode).save(path)
    else:
        finish_overwrite(spark, path)
        if mode == "overwrite":
            writer.mode("overwrite").save(path.rstrip("/") + NEXT)
            touch(spark, path.rstrip("/") + SWAP)
            finish_overwrite(spark, path)
        else:
            writer.mode(mode).save(path)
    m = obs.get
    return WriteResult(int(m.get("written") or 0), int(m.get("alerts") or 0))


def finish_overwrite(spark: SparkSession, path: str) -> None:
    """Moves a complete new table into the place of the old one, from whatever step an earlier attempt had reached.

    The mark ``SWAP`` says that the new table is complete; without it there is nothing to do, and what a failed write
    left beside the table is overwritten by the next one.  A failure at any step leaves the old or the new table where
    ``read_warehouse`` finds it, and the next write goes on from there.  Jobs that were reading files of the old table
    when it moved fail and must be run again; appends must not run meanwhile."""
    path = path.rstrip("/")
    if not path_exists(spark, path + SWAP):
        return
    if path_exists(spark, path + NEXT):
        if path_exists(spark, path):
            remove_path(spark, path + OLD)
            rename(spark, path, path + OLD)
        rename(spark, path + NEXT, path)
    remove_path(spark, path + OLD)
    remove_path(spark, path + SWAP)


def decided_rows(df: DataFrame, path: str, fmt: str = "parquet") -> tuple[DataFrame, PartitionProfile]:
    """The readings of ``df`` that are new or conflicting, with their ``STATUS`` (lazy), and the profile of ``df``.

    Only the table partitions that ``df`` touches are read, once."""
    if fmt in FILE_FORMATS:
        finish_overwrite(df.sparkSession, path)
    profile = partition_profile(df)
    existing = read_partitions(df.sparkSession, path, profile.partitions, fmt)
    return decide(df, existing).filter(F.col(STATUS).isin(NEW, CONFLICTING)), profile


def with_status(decided: DataFrame, status: str) -> DataFrame:
    return decided.filter(F.col(STATUS) == status).drop(STATUS)


def append_new(df: DataFrame, path: str, fmt: str = "parquet") -> WriteResult:
    """Idempotent append: only readings that the table does not hold are written."""
    decided, profile = decided_rows(df, path, fmt)
    if profile.empty:
        return WriteResult(0, 0)
    return write_warehouse(with_status(decided, NEW), path, "append", fmt, writer_count(df.sparkSession, profile))


QUARANTINE_ID = "quarantine_id"
SOURCE_DATE = "source_date"
OCCURRENCES = "occurrences"


def quarantine_rows(rejected: DataFrame) -> DataFrame:
    """Rejected / corrupt rows, one per content and source file, with the number
    of ``occurrences`` there, the place of the first one (where files are read
    value by value), a content id, reasons and source file.

    ``source_date`` (the source file's modification date, else the day of
    quarantine) is the table's partition column: re-reading the same files
    lands in the same partitions, so the re-run check reads only those.
    """
    cols = [c for c, _ in model.RAW_FIELDS]
    meta = [c for c in (model.CORRUPT_COLUMN, model.SOURCE_FILE_COLUMN, model.SOURCE_MODIFIED_COLUMN) if c in rejected.columns]
    reasons = ["reject_reasons"] if "reject_reasons" in rejected.columns else []
    parts = [*cols, *meta, *[F.array_join(r, ",") for r in reasons]]
    text = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("\u0000")) for p in parts]
    place = F.min(model.SOURCE_PLACE_COLUMN) if model.SOURCE_PLACE_COLUMN in rejected.columns else F.first(F.lit(None).cast("long"))
    modified = F.col(model.SOURCE_MODIFIED_COLUMN) if model.SOURCE_MODIFIED_COLUMN in rejected.columns else F.lit(None)
    counted = rejected.groupBy(*cols, *meta, *reasons).agg(F.count(F.lit(1)).alias(OCCURRENCES), place.alias(model.SOURCE_PLACE_COLUMN))
    return counted.withColumns(
        {
            QUARANTINE_ID: F.sha2(F.concat_ws("\u0001", *text), 256),
            SOURCE_DATE: F.coalesce(F.to_date(modified), F.current_date()),
        }
    )


def write_quarantine(rejected: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Append rejected rows not already quarantined (re-runs add nothing);
    returns the number of rejected rows that they stand for."""
    spark = rejected.sparkSession
    rows = quarantine_rows(rejected)
    if table_exists(spark, path):
        dates = [r[0] for r in rows.select(SOURCE_DATE).distinct().collect()]
        if not dates:
            return 0
        # explicit schema: a quarantine written by an empty batch has no data files
        keys = f"{QUARANTINE_ID} string, {SOURCE_DATE} date"
        known = spark.read.format(fmt).schema(keys).load(path).filter(F.col(SOURCE_DATE).isin(*[F.lit(d) for d in dates]))
        rows = rows.join(known.select(QUARANTINE_ID), QUARANTINE_ID, "left_anti")
    obs = observation("quarantine")
    rows = rows.withColumn("quarantined_at", F.current_timestamp()).observe(obs, F.sum(OCCURRENCES).alias("n"))
    rows.write.format(fmt).mode("append").partitionBy(SOURCE_DATE).save(path)
    return int(obs.get.get("n") or 0)


#: A file below this many bytes is small: compaction writes it again together with others.
SMALL_FILE = 64 << 20
#: Small files that are compacted in one job.
FILES_AT_ONCE = 5_000


def _small_files(spark: SparkSession, path: str, days: DataFrame | None, small: int) -> DataFrame:
    """``folder`` and ``path`` of the table's small files, where a partition has two or more; no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
    files = listed.select("path", F.col("_metadata.file_size").alias("size"), F.regexp_extract("path", "^(.*)/", 1).alias("folder")).filter(F.col("size") < small)
    if days is not None:
        named = F.concat(F.lit("year="), "year", F.lit("/month="), "month", F.lit("/day="), "day")
        files = files.withColumn("_day", F.regexp_extract("folder", "(year=[^/]*/month=[^/]*/day=[^/]*)$", 1))
        files = files.join(days.select(named.alias("_day")).distinct(), "_day", "left_semi")
    several = files.groupBy("folder").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("folder")
    return files.join(several, "folder", "left_semi").select("folder", "path").orderBy("folder", "path")


def compact(spark, path: str, days: DataFrame | None = None, fmt: str = "parquet", small: int = SMALL_FILE) -> int:
    """Rewrite the small files of the given days' partitions as few, large ones.

    Stream micro-batches leave many small files per day.  ``days`` is a
    DataFrame with ``year, month, day`` (e.g. the days a stream touched); None
    compacts every day.  Files of ``small`` bytes or more, and a small one that
    is alone in its partition, stay as they are.  Some thousand files at a
    time, whole partitions, are read and written again beside themselves, then
    exactly those files are deleted, so rows appended meanwhile stay and the
    driver holds one such list.  A failure before the new files are complete
    leaves the old ones; one while the old are being deleted leaves rows twice,
    never none.  Between the two steps readers see rows twice; a table format
    with transactions avoids that.  Returns the rows rewritten.
    """
    if fmt not in FILE_FORMATS:
        raise ValueError(f"{fmt} compacts its files itself")
    written, held, folder = 0, [], None

    def rewrite() -> int:
        old = spark.read.format(fmt).schema(model.WAREHOUSE_SCHEMA).option("basePath", path).load(held)
        n = write_warehouse(old, path, "append", fmt).written
        for f in held:
            remove_path(spark, f)
        return n

    for r in _small_files(spark, path, days, small).toLocalIterator():
        if r["folder"] != folder and len(held) >= FILES_AT_ONCE:
            written += rewrite()
            held = []
        folder = r["folder"]
        held.append(r["path"])
    return written + (rewrite() if held else 0)
