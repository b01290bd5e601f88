"""The state of a stream: its partitions follow the cores, and the steps behind it are planned like those of a batch."""

import json
import os

import pytest

from conftest import reading, write_text
from sensorlake.session import LEAST_STATE_PARTITIONS, STATE_PARTITIONS_PER_CORE, bounded_state
from sensorlake.sources.warehouse import read_warehouse
from sensorlake.streaming import ingest as stream_ingest
from sensorlake.streaming.ingest import start_ingest
from sensorlake.streaming.windows import start_windows


@pytest.fixture
def many(spark):
    """More shuffle partitions than a state is to have."""
    held = spark.conf.get("spark.sql.shuffle.partitions")
    most = max(LEAST_STATE_PARTITIONS, STATE_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(most + 8))
    yield most
    spark.conf.set("spark.sql.shuffle.partitions", held)


def land(root, name, *ids):
    write_text(f"{root}/temperature/{name}.json", "\n".join(json.dumps(reading(sensor_id=i)) for i in ids))


def partitions(checkpoint):
    return len([n for n in os.listdir(f"{checkpoint}/state/0") if n.isdigit()])


def test_state_has_partitions_for_the_cores(spark, tmp_path, many):
    root, ck = str(tmp_path / "raw"), str(tmp_path / "ck")
    land(root, "a", "1", "2", "1")
    options = dict(multi_line=False, available_now=True)
    start_ingest(spark, root, str(tmp_path / "wh"), f"{ck}/i", dedup="state", **options).awaitTermination()
    start_windows(spark, root, str(tmp_path / "out"), f"{ck}/w", **options).awaitTermination()
    assert partitions(f"{ck}/i") == partitions(f"{ck}/w") == many
    assert spark.conf.get("spark.sql.shuffle.partitions") == str(many + 8)
    assert sorted(r.sensor_id for r in read_warehouse(spark, str(tmp_path / "wh")).collect()) == ["1", "2"]


def test_fewer_shuffle_partitions_stay(spark):
    held = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ValueError), bounded_state(spark):
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(min(int(held), LEAST_STATE_PARTITIONS))
        raise ValueError
    assert spark.conf.get("spark.sql.shuffle.partitions") == held


def test_steps_of_a_stream_with_state_are_planned_adaptively(spark, tmp_path, monkeypatch):
    seen, decided = [], stream_ingest.decided_rows

    def noted(rows, *args):
        seen.append(rows.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        return decided(rows, *args)

    monkeypatch.setattr(stream_ingest, "decided_rows", noted)
    land(str(tmp_path / "raw"), "a", "1")
    start_ingest(spark, str(tmp_path / "raw"), str(tmp_path / "wh"), str(tmp_path / "ck"), multi_line=False, dedup="state", available_now=True).awaitTermination()
    assert set(seen) == {"true"}


def test_stream_dedup_bounds_its_state(spark, tmp_path, monkeypatch, many):
    """Two events, each landed twice, pass once."""
    from sensorlake import queries

    events = "1L AS event_id, timestamp_ntz'2024-01-02 03:04:05' AS ts, 7L AS user_id, 'click' AS event_type, 20.5D AS value, '' AS props"
    rows = spark.range(1).selectExpr(*events.split(", "))
    rows.unionByName(rows.withColumn("event_id", rows.event_id + 1)).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    left = []
    monkeypatch.setattr(queries, "_forget", lambda _, *paths: left.extend(paths))
    found = queries.stream_dedup(spark, str(tmp_path))
    assert sorted(r.sensor_id for r in found.collect()) == ["1", "2"]
    checkpoint = left[-1].removeprefix("file://").removeprefix("file:")
    assert partitions(checkpoint) == many
