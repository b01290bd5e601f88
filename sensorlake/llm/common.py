"""Small helpers shared by the operators: tables, shared scratch, Arrow columns."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.session import scratch_path

#: The six ASCII white-space characters that separate words.
SPACES = b" \t\n\x0b\x0c\r"

#: Text handled at once inside a task, in bytes: bounds what a worker holds beside the Arrow batch.
SLICE_BYTES = 2 << 20


#: Bytes of an Arrow batch, where the session has Spark's own default: a task holds several batches at once.
BATCH_BYTES = "8m"


def prepare(spark: SparkSession) -> None:
    """Lets Python workers that see this folder import the library from it (elsewhere it is
    shipped as a package), and keeps Arrow batches small unless the session says otherwise."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in ("64m", f"{64 << 20}b", str(64 << 20)):
        spark.conf.set(name, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts the
    lineage, so later passes neither recompute it nor depend on an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of ``column``, one row at least.
    Behind each piece, memory that Arrow holds without use goes back."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)
        pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def prefix_sums(lengths: Column) -> Column:
    """Running totals of an array column, inclusive, in about n log n steps and without Python:
    pass k adds to each element the one 2^k places before it."""
    power = lambda k: F.call_function("shiftleft", F.lit(1), k)
    passes = F.when(F.size(lengths) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(lengths).cast("double"))).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    return F.aggregate(
        passes,
        F.transform(lengths, lambda x: x.cast("long")),
        lambda acc, k: F.transform(
            acc, lambda x, i: x + F.when(i >= power(k), F.get(acc, i - power(k))).otherwise(F.lit(0))
        ),
    )
