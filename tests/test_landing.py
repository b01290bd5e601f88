"""The landing folders of the stream queries: files grow with the readings, their number is bounded, no reading is left out."""

import os

import pytest
from pyspark.sql import functions as F

from sensorlake import model
from sensorlake.sources import events
from sensorlake.sources.events import land_arrays, land_damaged, land_readings
from sensorlake.sources.json_files import read_sensor_dirs
from sensorlake.sources.json_values import read_values


def readings(spark, n, parts=1):
    types = F.array(*[F.lit(t) for t in model.SENSOR_TYPES])
    rows = spark.range(0, n, 1, parts).select(F.col("id").cast("string").alias("sensor_id"), F.element_at(types, (F.col("id") % 3 + 1).cast("int")).alias("type"))
    rest = {"value": F.lit(1.5), "unit": F.lit("u"), "site": F.lit("s"), "machine": F.lit("m"), "timestamp": F.lit("2026-01-08T06:12:07.250911")}
    return rows.withColumns(rest)


def files(root):
    return {t: len([n for n in os.listdir(f"{root}/{t}") if n.startswith("part-")]) for t in model.SENSOR_TYPES}


def test_line_files_do_not_follow_the_partitions(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "few")
    land_readings(readings(spark, 60, 16), root)
    assert set(files(root).values()) == {1}
    monkeypatch.setattr(events, "READINGS_PER_FILE", 5)
    root = str(tmp_path / "many")
    land_readings(readings(spark, 60, 16), root)  # 20 of a type
    assert set(files(root).values()) == {events.LINE_FILES}
    found = read_sensor_dirs(spark, root, multi_line=False)
    assert sorted(int(r.sensor_id) for r in found.collect()) == list(range(60))


@pytest.mark.parametrize("land", [land_arrays, land_damaged])
def test_files_of_values_grow_beyond_a_number(spark, tmp_path, land):
    root = str(tmp_path / "raw")
    land(readings(spark, 300), root, per_file=10, most=4)  # 100 of a type
    assert all(n <= 4 for n in files(root).values())
    found = read_values(spark, [f"{root}/{t}" for t in model.SENSOR_TYPES], "part-*")
    corrupt = F.regexp_extract_all(model.CORRUPT_COLUMN, F.lit('"sensor_id":"([0-9]+)"'))
    ids = found.select(F.explode(F.coalesce(corrupt, F.array("sensor_id"))).alias("i"))
    assert sorted(int(r.i) for r in ids.collect()) == list(range(300))
