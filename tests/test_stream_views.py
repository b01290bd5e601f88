"""Windows kept by the stream's own state (X2) and row extracts appended to batch by batch."""

import json
import os

import pytest

from conftest import reading, write_text
from sensorlake.plans.exports import export_all
from sensorlake.sources.warehouse import read_warehouse
from sensorlake.streaming import ingest as stream_ingest
from sensorlake.streaming.ingest import read_row_export, start_ingest
from sensorlake.streaming.windows import late_readings, read_windows, start_windows


def land(root, name, *rows):
    path = write_text(f"{root}/temperature/{name}.json", "\n".join(json.dumps(reading(**r)) for r in rows))
    os.utime(path, (1_700_000_000 + len(os.listdir(os.path.dirname(path))),) * 2)


def at(i, hour, value=20.0, day=8):
    return {"sensor_id": i, "timestamp": f"2026-01-{day:02d}T{hour:02d}:30:00", "value": value}


def shown(spark, path):
    return sorted((r.window_start.day, r.window_start.hour, r.type, r.nombre_mesures, r.valeur_moyenne, r.alertes) for r in read_windows(spark, path).collect())


@pytest.mark.parametrize("fold", [1, 2, 100])
def test_windows_take_readings_in_any_order(spark, tmp_path, fold):
    root, out, ck = (str(tmp_path / n) for n in ("raw", "out", "ck"))
    start = lambda: start_windows(spark, root, out, ck, multi_line=False, available_now=True, max_files_per_trigger=1, fold=fold).awaitTermination()
    land(root, "a", at("1", 10), at("2", 10, 99.0), at("3", 11))
    land(root, "b", at("4", 23, day=20), {"sensor_id": "bad", "value": -1.0})
    start()
    assert shown(spark, out) == [(8, 10, "temperature", 2, 59.5, 1), (8, 11, "temperature", 1, 20.0, 0), (20, 23, "temperature", 1, 20.0, 0)]
    land(root, "c", at("5", 10, 30.5))  # twelve days behind
    start()  # from the checkpoint
    assert shown(spark, out)[0] == (8, 10, "temperature", 3, 49.83, 1)
    parts = [n for n in os.listdir(f"{out}/{os.listdir(out)[0]}") if n.startswith("batch_id=")] if fold == 1 else []
    assert len(parts) <= 1
    assert read_windows(spark, str(tmp_path / "none")).count() == 0


def test_windows_are_not_computed_in_one_task(spark, tmp_path, monkeypatch):
    """What a trigger and a fold write is shuffled into its one file: a coalesce would pull the state's partitions into one task."""
    from sensorlake.streaming import windows

    plans, write = [], windows._write_part

    def noted(rows, *args):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        write(rows, *args)

    monkeypatch.setattr(windows, "_write_part", noted)
    land(str(tmp_path / "raw"), "a", at("1", 10), at("2", 11))
    start_windows(spark, str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ck"), multi_line=False, available_now=True, fold=1).awaitTermination()
    assert len(plans) == 2 and not [p for p in plans if "Repartition 1, false" in p]
    assert len(shown(spark, str(tmp_path / "out"))) == 2


def test_late_readings_are_counted(spark, tmp_path):
    root, out, ck = (str(tmp_path / n) for n in ("raw", "out", "ck"))
    land(root, "a", at("1", 10), at("2", 11))
    land(root, "b", at("3", 10, day=20))
    land(root, "c", at("4", 10), at("5", 12, day=20))  # Spark drops by the watermark of the trigger before
    land(root, "d", at("6", 10), at("7", 12, day=20))
    query = start_windows(spark, root, out, ck, multi_line=False, delay="1 day", available_now=True, max_files_per_trigger=1)
    query.awaitTermination()
    assert late_readings(query) == 1 and sum(r[3] for r in shown(spark, out)) == 6


def ids(spark, out, name):
    return sorted(r.sensor_id for r in read_row_export(spark, out, name, "sensor_id string").collect())


def test_row_extracts_grow_by_each_batch_and_survive_a_replay(spark, tmp_path, monkeypatch):
    root, wh, out, ck = (str(tmp_path / n) for n in ("raw", "wh", "out", "ck"))
    options = dict(multi_line=False, available_now=True, max_files_per_trigger=1, row_exports_path=out)
    assert read_row_export(spark, out, "raw_data").count() == 0
    land(root, "a", at("1", 10), at("2", 10, 99.0))
    land(root, "b", at("1", 10), at("3", 11))
    start_ingest(spark, root, wh, ck, **options).awaitTermination()
    assert ids(spark, out, "raw_data") == ["1", "2", "3"] and ids(spark, out, "critical_alerts") == ["2"]
    land(root, "c", at("4", 12, 98.0))
    real = stream_ingest.write_warehouse

    def broken(*args, **kwargs):
        raise OSError("crash")

    monkeypatch.setattr(stream_ingest, "write_warehouse", broken)
    with pytest.raises(Exception, match="crash"):
        start_ingest(spark, root, wh, ck, **options).awaitTermination()
    monkeypatch.setattr(stream_ingest, "write_warehouse", real)
    start_ingest(spark, root, wh, ck, **options).awaitTermination()
    assert ids(spark, out, "raw_data") == ["1", "2", "3", "4"] and ids(spark, out, "critical_alerts") == ["2", "4"]
    whole = str(tmp_path / "whole")
    export_all(read_warehouse(spark, wh), whole)
    for name in ("raw_data", "critical_alerts"):
        columns = spark.read.option("header", True).csv(f"{whole}/{name}").columns
        got = read_row_export(spark, out, name)
        assert got.columns == columns
        drop = [c for c in columns if "ingestion" in c]
        rows = lambda df: sorted(map(repr, df.drop(*drop).collect()))
        assert rows(got) == rows(spark.read.option("header", True).csv(f"{whole}/{name}"))
