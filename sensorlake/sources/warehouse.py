"""Warehouse table reads."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import model
from sensorlake.session import list_names
from sensorlake.sources.json_files import path_exists


FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")


#: Beside a table while it is overwritten: the new one, the old one, and the mark that the new one is complete.
NEXT, OLD, SWAP = ".next", ".old", ".swap"


def table_path(spark: SparkSession, path: str) -> str | None:
    """Where the table is: at ``path``; while an overwrite moves it (or was interrupted there), at its old or new place;
    None if there is none."""
    path = path.rstrip("/")
    if path_exists(spark, path):
        return path
    if path_exists(spark, path + SWAP):
        return next((p for p in (path + OLD, path + NEXT, path) if path_exists(spark, p)), None)
    return None


def table_exists(spark: SparkSession, path: str) -> bool:
    """The warehouse path exists (any format)."""
    return table_path(spark, path) is not None


def read_warehouse(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The warehouse table with its declared schema.

    The explicit schema keeps partition values typed as declared (``site``
    stays a string even if every value looks numeric).  Filters on the
    partition columns (``site, type, year, month, day``) prune directories.
    """
    found = table_path(spark, path)
    if found is None:
        raise FileNotFoundError(f"warehouse table not found: {path}")
    if fmt in FILE_FORMATS:
        return spark.read.format(fmt).schema(model.WAREHOUSE_SCHEMA).load(found)
    # table formats (delta) keep their own schema and refuse a read schema
    return spark.read.format(fmt).load(found).select(*model.WAREHOUSE_COLUMNS)


def partition_dir(partition: Iterable) -> str:
    """Directory of a partition under the table, as Spark's writers name it."""
    text = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None or v == "" else str(v)
    plain = lambda v: re.sub(r'[\x00-\x1f\x7f"#%\'*/:=?\\{\[\]^]', lambda m: f"%{ord(m[0]):02X}", v)
    return "/".join(f"{c}={plain(text(v))}" for c, v in zip(model.PARTITION_COLUMNS, partition))


def read_partitions(spark: SparkSession, path: str, partitions: Iterable[tuple], fmt: str = "parquet") -> DataFrame | None:
    """The rows of the given (site, type, year, month, day) partitions; None if there are none of them.

    Only their directories are listed, a month of a site and type at a time, not the table's whole tree."""
    partitions = list(partitions)
    found = table_path(spark, path) if partitions else None
    if found is None:
        return None
    if fmt not in FILE_FORMATS:
        wanted = spark.createDataFrame(partitions, ", ".join(f"{c} {model.WAREHOUSE_SCHEMA[c].dataType.simpleString()}" for c in model.PARTITION_COLUMNS))
        return read_warehouse(spark, path, fmt).join(F.broadcast(wanted), list(model.PARTITION_COLUMNS), "left_semi").select(*model.WAREHOUSE_COLUMNS)
    days_of: dict[str, list[str]] = {}
    for p in partitions:
        month, day = partition_dir(p).rsplit("/", 1)
        days_of.setdefault(month, []).append(day)
    root = found.rstrip("/")
    held = {month: set(list_names(spark, f"{root}/{month}")) for month in days_of}
    dirs = [f"{root}/{month}/{day}" for month, days in days_of.items() for day in days if day in held[month]]
    if not dirs:
        return None
    return spark.read.format(fmt).schema(model.WAREHOUSE_SCHEMA).option("basePath", root).load(dirs)


def register_view(df: DataFrame, name: str = "sensor_data") -> DataFrame:
    """Expose a snapshot to SQL reports."""
    df.createOrReplaceTempView(name)
    return df


def read_csv_warehouse(spark: SparkSession, path: str) -> DataFrame:
    """A CSV extract of the warehouse (header row, declared schema)."""
    return (
        spark.read.schema(model.WAREHOUSE_SCHEMA)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
