"""Which landed files were read (B1, S2, S11), so that a run reads only files that are new or have changed.

The ledger is a table with one row per file and version of it (path, length,
modification time), appended after the batch that read the file is in the
warehouse.  A file that grew or was written again is another version, so a file
that was read half written is read once more when it is complete; rows of an
older version in the quarantine then count as healed.  A run that fails before
the entry is made reads its files again, which the idempotent append absorbs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake import model
from sensorlake.sources.json_files import JSON_GLOB, path_exists

#: ``path`` as `_metadata.file_path` has it; the counts are of the rows that the file gave.
LEDGER_SCHEMA = "path string, length bigint, modified timestamp, rows bigint, corrupt bigint, read_at timestamp"
_VERSION = ("path", "length", "modified")


def landed_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = JSON_GLOB) -> DataFrame:
    """The files under ``paths``: ``location`` (to read it by), ``path``, ``length`` and ``modified``; no file is opened.
    Files without a byte are left out, as Spark's scans do."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load([paths] if isinstance(paths, str) else list(paths))
    return files.select(
        F.col("path").alias("location"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Every version of a file that was read."""
    if not path_exists(spark, ledger_path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def unread_files(spark: SparkSession, paths: Sequence[str], ledger_path: str, glob: str | None = JSON_GLOB) -> DataFrame:
    """``landed_files`` whose version the ledger does not have."""
    return landed_files(spark, paths, glob).join(read_ledger(spark, ledger_path).select(*_VERSION), list(_VERSION), "left_anti")


def note_files(files: list, staged: DataFrame, ledger_path: str) -> None:
    """Enters the versions ``files`` (rows of ``unread_files``), with the numbers of rows that they gave in ``staged``."""
    spark = staged.sparkSession
    versions = spark.createDataFrame([tuple(f[c] for c in _VERSION) for f in files], "path string, length bigint, modified timestamp")
    gave = staged.groupBy(F.col(model.SOURCE_FILE_COLUMN).alias("_file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(model.CORRUPT_COLUMN).alias("corrupt")
    )
    met = versions.join(gave, F.col("path") == F.col("_file"), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("rows", "corrupt")]
    met.select(*_VERSION, *counts, F.current_timestamp().alias("read_at")).coalesce(1).write.mode("append").parquet(ledger_path)


def latest_versions(ledger: DataFrame) -> DataFrame:
    """The ledger's newest entry of each file."""
    newest = Window.partitionBy("path").orderBy(F.desc("modified"), F.desc("read_at"), F.desc("length"))
    return ledger.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")


def with_healed(quarantined: DataFrame, ledger: DataFrame) -> DataFrame:
    """Quarantined rows with ``healed``: their file was written again later and read since."""
    newest = latest_versions(ledger).select(F.col("path").alias("_path"), F.col("modified").alias("_newest"))
    met = quarantined.join(newest, F.col(model.SOURCE_FILE_COLUMN) == F.col("_path"), "left")
    healed = F.coalesce(F.col("_newest") > F.col(model.SOURCE_MODIFIED_COLUMN), F.lit(False))
    return met.select(*quarantined.columns, healed.alias("healed"))


def changed_corrupt_files(spark: SparkSession, paths: Sequence[str], quarantine_path: str, ledger_path: str, glob: str | None = JSON_GLOB) -> DataFrame:
    """Unread versions of the files that gave a corrupt record before: what a stream, which reads a file once, has
    to be given again."""
    held = spark.read.parquet(quarantine_path).filter(F.col(model.CORRUPT_COLUMN).isNotNull())
    bad = held.groupBy(F.col(model.SOURCE_FILE_COLUMN).alias("_bad")).agg(F.max(model.SOURCE_MODIFIED_COLUMN).alias("_then"))
    files = unread_files(spark, paths, ledger_path, glob)
    return files.join(bad, (F.col("path") == F.col("_bad")) & (F.col("modified") > F.col("_then"))).select(*files.columns)
