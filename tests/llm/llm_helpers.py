"""Constants and fixtures of the tests of this folder (imported by name: a second ``conftest`` would hide the other)."""

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
)


@pytest.fixture
def docs(spark):
    """Builds a documents table from (doc_id, text[, source]) rows, spread over three partitions."""

    def make(given, /, **extra):
        full = [(*r, "s")[:3] if len(r) == 2 else tuple(r) for r in given]
        frame = spark.createDataFrame(full, DOCS).repartition(3)
        for name, value in extra.items():
            frame = frame.withColumn(name, value)
        return frame

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """doc_id and text of the smallest test table."""
    return [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
