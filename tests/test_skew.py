"""Skew: a hot table partition is split across writers; a hot duplicate collapses."""

import datetime as dt
import os

from pyspark.sql import functions as F

from sensorlake import model
from sensorlake.sinks.warehouse import append_new, write_warehouse
from sensorlake.sources.warehouse import read_warehouse


def _rows(spark, n_hot, n_cold):
    base = spark.range(n_hot + n_cold)
    hot = F.col("id") < n_hot
    return base.select(
        F.concat(F.lit("s-"), F.col("id").cast("string")).alias("sensor_id"),
        F.lit("temperature").alias("type"),
        (F.col("id") % 90).cast("double").alias("value"),
        F.lit("Celsius").alias("unit"),
        F.when(hot, F.lit("Site_Hot")).otherwise(F.concat(F.lit("Site_"), (F.col("id") % 4).cast("string"))).alias("site"),
        F.lit("Machine_A1").alias("machine"),
        F.lit(dt.datetime(2026, 1, 8, 10, 0)).cast("timestamp").alias("timestamp"),
        F.lit(2026).alias("year"), F.lit(1).alias("month"), F.lit(8).alias("day"), F.lit(10).alias("hour"),
        ((F.col("id") % 90) > 85).alias("is_alert"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def test_hot_partition_is_split_across_writers(spark, tmp_path):
    path = str(tmp_path / "wh")
    write_warehouse(_rows(spark, 30_000, 200), path, writers=6)
    hot_dir = tmp_path / "wh" / "site=Site_Hot" / "type=temperature" / "year=2026" / "month=1" / "day=8"
    sizes = [os.path.getsize(hot_dir / f) for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert len(sizes) >= 4  # one site-day, many writers
    assert max(sizes) < 3 * min(sizes)  # of similar size
    cold = [d for d in (tmp_path / "wh").iterdir() if d.name.startswith("site=Site_") and d.name != "site=Site_Hot"]
    for d in cold:  # small partitions stay in one file each
        files = [f for f in (d / "type=temperature/year=2026/month=1/day=8").iterdir() if f.suffix == ".parquet"]
        assert len(files) <= 2


def test_hot_duplicate_collapses(spark, tmp_path):
    path = str(tmp_path / "wh")
    rows = _rows(spark, 0, 3_000)
    # one reading repeated 1,500 times: a third of the batch
    copies = (
        rows.filter(F.col("sensor_id") == "s-7")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(1_500))))
        .drop("_copy")
    )
    batch = rows.unionByName(copies)
    assert batch.filter(F.col("sensor_id") == "s-7").count() == 1_501
    assert append_new(batch, path).written == 3_000
    table = read_warehouse(spark, path)
    assert table.count() == 3_000 and table.filter(F.col("sensor_id") == "s-7").count() == 1
    assert tuple(table.columns) != ()  # readable with the declared schema
    assert set(model.WAREHOUSE_COLUMNS) == set(table.columns)


def test_writer_count_rule(spark):
    from sensorlake.operators.dedup import PartitionProfile
    from sensorlake.sinks.warehouse import ROWS_PER_WRITER, writer_count

    cores = spark.sparkContext.defaultParallelism
    assert writer_count(spark, PartitionProfile([("S", "t", 2026, 1, 8, 10)])) == 1  # no tiny file per core
    assert writer_count(spark, PartitionProfile([("S", "t", 2026, 1, d, 10) for d in range(1, 29)])) == min(cores, 28)
    # by rows, without an upper bound
    assert writer_count(spark, PartitionProfile([("S", "t", 2026, 1, 8, 5000 * ROWS_PER_WRITER)])) == 5000
