"""What a stream stages of a batch: the valid rows, and the rejected ones where they are asked for."""

import json

import pytest

from conftest import reading, write_text
from sensorlake.sources.warehouse import read_warehouse
from sensorlake.streaming import ingest as stream_ingest
from sensorlake.streaming.ingest import start_ingest


@pytest.fixture
def paths(tmp_path):
    root = str(tmp_path / "raw")
    rows = [reading(sensor_id="1"), reading(sensor_id="2", type="unknown"), reading(sensor_id="3", value=-1.0)]
    write_text(f"{root}/temperature/a.json", "\n".join(map(json.dumps, rows)))
    return root, str(tmp_path / "wh"), str(tmp_path / "ck"), str(tmp_path / "qu")


def run(spark, paths, **options):
    start_ingest(spark, *paths[:3], multi_line=False, available_now=True, **options).awaitTermination()


def break_write(monkeypatch):
    def broken(*args, **kwargs):
        raise OSError("crash")

    monkeypatch.setattr(stream_ingest, "write_warehouse", broken)


def test_rejected_rows_are_staged_only_where_they_go_somewhere(spark, paths, monkeypatch):
    break_write(monkeypatch)
    with pytest.raises(Exception, match="crash"):
        run(spark, paths)
    held = spark.read.parquet(f"{paths[2]}/_staged/0/valid")
    assert [r.sensor_id for r in held.collect()] == ["1"] and "reject_reasons" not in held.columns


def test_a_replay_that_now_has_a_quarantine_fills_it(spark, paths, monkeypatch):
    with monkeypatch.context() as m:
        break_write(m)
        with pytest.raises(Exception, match="crash"):
            run(spark, paths)
    run(spark, paths, quarantine_path=paths[3])
    assert [r.sensor_id for r in read_warehouse(spark, paths[1]).collect()] == ["1"]
    assert sorted(r.sensor_id for r in spark.read.parquet(paths[3]).collect()) == ["2", "3"]
