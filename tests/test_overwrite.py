"""An overwrite that fails at any step leaves the old or the new table, and the next write finishes it (K1); published files
are replaced in one step (K4, R4)."""

import os

import pytest

from conftest import reading
from sensorlake import model
from sensorlake.plans.ingest import ingest_frame
from sensorlake.session import replace_file
from sensorlake.sinks import warehouse as sink
from sensorlake.sinks.csv import export_single_csv
from sensorlake.sources.warehouse import read_partitions, read_warehouse, table_exists
from sensorlake.streaming.monitor import _publish


def ingest(spark, wh, ids, **options):
    rows = [reading(sensor_id=i) for i in ids]
    return ingest_frame(spark.createDataFrame([tuple(r[f] for f, _ in model.RAW_FIELDS) for r in rows], model.RAW_SCHEMA), wh, **options)


def stored(spark, wh):
    return "".join(sorted(r.sensor_id for r in read_warehouse(spark, wh).collect()))


def beside(wh):
    return sorted(n for n in os.listdir(os.path.dirname(wh)) if n.startswith(os.path.basename(wh)) and not n.endswith(".crc"))


#: What the overwrite calls, in this order: the mark, then old table aside, new table in place, then the two removals.
STEPS = [("touch", 1), ("rename", 1), ("rename", 2), ("remove_path", 2), ("remove_path", 3)]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_a_failure_at_every_step(spark, tmp_path, monkeypatch, step, after):
    wh = str(tmp_path / "wh")
    ingest(spark, wh, "abc")
    name, nth = step
    calls, real = [0], getattr(sink, name)

    def fails(session, *paths):
        if not any(str(p).startswith(wh) for p in paths):
            return real(session, *paths)
        calls[0] += 1
        if calls[0] == nth and not after:
            raise OSError("crash")
        real(session, *paths)
        if calls[0] == nth:
            raise OSError("crash")

    monkeypatch.setattr(sink, name, fails)
    with pytest.raises(OSError):
        ingest(spark, wh, "xy", mode="overwrite")
    monkeypatch.undo()
    assert table_exists(spark, wh) and stored(spark, wh) in ("abc", "xy")
    partition = [("Plant_North", "temperature", 2026, 1, 8)]
    assert read_partitions(spark, wh, partition).count() in (2, 3)
    committed = (name, after) != ("touch", False)
    ingest(spark, wh, "z")
    assert stored(spark, wh) == ("xyz" if committed else "abcz")
    ingest(spark, wh, "n", mode="overwrite")
    assert stored(spark, wh) == "n" and beside(wh) == ["wh"]


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    from pyspark.sql import functions as F

    wh = str(tmp_path / "wh")
    ingest(spark, wh, "abc")
    bad = read_warehouse(spark, wh).withColumn("hour", F.when(F.col("sensor_id") == "b", F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("hour")))
    with pytest.raises(Exception, match="broken"):
        sink.write_warehouse(bad, wh, "overwrite", writers=1)
    assert stored(spark, wh) == "abc"
    ingest(spark, wh, "d", mode="overwrite")
    assert stored(spark, wh) == "d" and beside(wh) == ["wh"]


def test_a_table_may_be_overwritten_by_its_own_rows(spark, tmp_path):
    wh = str(tmp_path / "wh")
    ingest(spark, wh, "abc")
    assert sink.write_warehouse(read_warehouse(spark, wh).filter("sensor_id <> 'b'"), wh, "overwrite").written == 2
    assert stored(spark, wh) == "ac"


def test_published_files_are_replaced_in_one_step(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    for n in (3, 1):
        path = export_single_csv(spark.range(n), out, "numbers")
        assert spark.read.option("header", True).csv(path).count() == n and os.listdir(out).count("numbers.csv") == 1
        _publish(spark.range(n), f"{out}/view")
        assert spark.read.parquet(f"{out}/view").count() == n
    from sensorlake.sinks import csv as sink_csv

    def broken(*args):
        raise OSError("crash")

    monkeypatch.setattr(sink_csv, "replace_file", broken)
    with pytest.raises(OSError):
        export_single_csv(spark.range(9), out, "numbers")
    assert spark.read.option("header", True).csv(f"{out}/numbers.csv").count() == 1  # the old one
    open(f"{out}/a", "w").write("new")
    replace_file(spark, f"{out}/a", f"{out}/deep/er/b")
    assert open(f"{out}/deep/er/b").read() == "new" and not os.path.exists(f"{out}/a")
