"""K3/K4/S10 exports, X2 hourly windows, and plan checks."""

import os
from functools import partial

import pytest

from sensorlake import model
from sensorlake.operators import reports
from sensorlake.plans.exports import export_all, run_reports
from sensorlake.plans import ingest
from sensorlake.sinks.csv import export_single_csv, write_csv
from sensorlake.sources.warehouse import read_csv_warehouse, read_warehouse, register_view, table_exists
from sensorlake.streaming.ingest import start_ingest
from sensorlake.streaming.latest import read_summary
from sensorlake.streaming.monitor import hourly_windows, monitor_publisher

from conftest import reading, write_pretty

ingest_batch = partial(ingest.ingest_batch, multi_line=True)


def _land(root, n, hour=10, start=0, t="temperature"):
    for i in range(start, start + n):
        write_pretty(f"{root}/{t}/r{i}.json", reading(sensor_id=f"{t}-{i}", type=t, value=84.0 + i,
                                                       timestamp=f"2026-01-08T{hour:02d}:{i % 60:02d}:00"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_export_files(spark, tmp_path):
    root, wh = str(tmp_path / "raw"), str(tmp_path / "wh")
    _land(root, 8)
    ingest_batch(spark, root, wh)
    table = read_warehouse(spark, wh)
    out = str(tmp_path / "reports")
    timings = export_all(table, out)
    assert set(timings) == set(reports.BI_EXPORTS)
    for name in reports.BI_EXPORTS:
        if name in ("raw_data", "critical_alerts"):
            assert os.path.isdir(f"{out}/{name}"), name
        else:
            assert os.path.isfile(f"{out}/{name}.csv"), name
    with open(f"{out}/stats_by_type.csv") as f:
        assert f.readline().strip().startswith("type,total_mesures")
    # no alert: header-only output, never a stale list
    export_all(table.filter("false"), out)
    lines = []
    for part in sorted(os.listdir(f"{out}/critical_alerts")):
        if part.endswith(".csv"):
            with open(f"{out}/critical_alerts/{part}") as f:
                lines += f.read().strip().splitlines()
    assert lines == ["sensor_id,type,value,unit,site,machine,timestamp,ingestion_timestamp"]
    export_single_csv(reports.stats_by_type(table.filter("false")), out, "empty_stats")
    with open(f"{out}/empty_stats.csv") as f:
        assert len(f.read().strip().splitlines()) == 1
    decision = run_reports(table, str(tmp_path / "decision"))
    assert set(decision) == set(reports.DECISION_REPORTS)
    # CSV round trip of the warehouse
    write_csv(table.select(*model.WAREHOUSE_COLUMNS), str(tmp_path / "csv"))
    back = read_csv_warehouse(spark, str(tmp_path / "csv"))
    assert back.count() == 8 and dict(back.dtypes)["timestamp"] == "timestamp"
    assert register_view(table).sparkSession.sql("SELECT COUNT(*) AS n FROM sensor_data").first().n == 8
    assert table_exists(spark, wh) and not table_exists(spark, str(tmp_path / "nope"))


def test_hourly_windows_from_the_kept_summary_drop_nothing(spark, tmp_path):
    root, wh, ck, kept = (str(tmp_path / n) for n in ("raw", "wh", "ck", "summary"))
    for start, hour in ((0, 20), (3, 20), (5, 1)):  # the last batch lies 19 hours behind
        _land(root, 2, start=start, hour=hour)
        start_ingest(spark, root, wh, ck, available_now=True, multi_line=True, summary_path=kept).awaitTermination()
    rows = {r.window_start.hour: (r.nombre_mesures, r.alertes) for r in hourly_windows(read_summary(spark, kept)).collect()}
    assert rows == {20: (4, 2), 1: (2, 2)}
    assert sorted(map(tuple, hourly_windows(read_warehouse(spark, wh)).collect())) == sorted(map(tuple, hourly_windows(read_summary(spark, kept)).collect()))


def test_live_monitor_counts_each_reading_once(spark, tmp_path):
    root, out, wh, kept = (str(tmp_path / n) for n in ("raw", "mon", "wh", "summary"))
    _land(root, 4)
    _land(root, 2, t="pressure")
    write_pretty(f"{root}/temperature/again.json", reading(sensor_id="temperature-0", value=84.0, timestamp="2026-01-08T10:00:00"))
    start_ingest(spark, root, wh, str(tmp_path / "ck"), available_now=True, multi_line=True, max_files_per_trigger=2,
                 summary_path=kept, on_batch=monitor_publisher(wh, out, summary_path=kept)).awaitTermination()
    assert {r.type: r["count"] for r in spark.read.parquet(f"{out}/stats").collect()} == {"temperature": 4, "pressure": 2}


def test_partition_pruning_and_pushdown(spark, tmp_path):
    root, wh = str(tmp_path / "raw"), str(tmp_path / "wh")
    _land(root, 3)
    ingest_batch(spark, root, wh)
    table = read_warehouse(spark, wh)
    plan = _plan(reports.temperature_by_machine_day(table))
    assert "PartitionFilters: [isnotnull(type" in plan and "(type#" in plan
    alerts = _plan(reports.critical_alerts(table))
    assert "PushedFilters: [IsNotNull(is_alert), EqualTo(is_alert,true)]" in alerts
    scan = [line for line in _plan(reports.pressure_hourly(table)).splitlines() if "ReadSchema" in line][0]
    assert "sensor_id" not in scan.split("ReadSchema")[1]  # columns pruned


def test_no_python_in_any_report_plan(spark, tmp_path):
    table = spark.createDataFrame([], model.WAREHOUSE_SCHEMA)
    for name, fn in {**reports.DECISION_REPORTS, **reports.BI_EXPORTS}.items():
        plan = _plan(fn(table))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name


def test_dashboard_distinct_counts_on_pre_aggregated_rows(spark):
    table = spark.createDataFrame([], model.WAREHOUSE_SCHEMA)
    plan = reports.dashboard_summary(table)._jdf.queryExecution().optimizedPlan().toString()
    # the Expand of the distinct counts sits above the (site, machine) pre-aggregate
    assert plan.index("Expand") < plan.rindex("Aggregate [site")


def test_grouping_sets_expand_groups_not_rows(spark):
    plan = reports.warehouse_stats(spark.createDataFrame([], model.WAREHOUSE_SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate [type")


def _accepted(spark, root):
    from sensorlake.plans.ingest import accepted_rows, staged_rows
    from sensorlake.sources.json_files import read_sensor_dirs

    return accepted_rows(staged_rows(read_sensor_dirs(spark, root, multi_line=True)))


def test_idempotent_append_plan(spark, tmp_path):
    from sensorlake.sinks.warehouse import _for_writers, decided_rows

    root, wh = str(tmp_path / "raw"), str(tmp_path / "wh")
    _land(root, 6)
    ingest_batch(spark, root, wh)
    decided, profile = decided_rows(_accepted(spark, root), wh)
    assert profile.total == 6 and len(profile.partitions) == 1
    plan = _plan(_for_writers(decided, 4))
    # one pass: the batch and the touched partitions once each, no join
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan and "EvalPython" not in plan
    # writers: range partitioning with the unique key as the last field
    assert "rangepartitioning(site" in plan and "sensor_id" in plan.split("rangepartitioning(")[1].split(")")[0]
    assert decided.count() == 0


def test_decisions(spark):
    from sensorlake.operators.dedup import STATUS, decide

    def rows(*given):
        from datetime import datetime

        full = [(i, "temperature", v, "C", site, m, datetime(2026, 1, 8, h), 2026, 1, 8, h, False, None) for i, site, v, m, h in given]
        return spark.createDataFrame(full, model.WAREHOUSE_SCHEMA)

    held = rows(("a", "S", 1.0, "m", 1), ("b", "S", 1.0, None, 1), ("b", "S", 2.0, None, 1), ("z", "S", 1.0, "m", 1))
    batch = rows(
        ("a", "S", 1.0, "m", 1), ("a", "S", 1.0, "m", 1), ("a", "S", 1.0, "m", 2), ("a", "T", 1.0, "m", 1), ("b", "S", 2.0, None, 1),
        ("c", "S", 3.0, "m", 5), ("c", "S", 4.0, "m", 4), ("c", "S", 3.5, "m", 4), ("c", "S", 3.5, None, 4), ("d", "S", 1.0, "m", 0),
    )
    got = sorted((r.sensor_id, r.site, r.value, r.machine or "", r.hour, r[STATUS]) for r in decide(batch, held).collect())
    assert got == [
        ("a", "S", 1.0, "m", 1, "repeated"), ("a", "S", 1.0, "m", 2, "conflicting"), ("a", "T", 1.0, "m", 1, "new"), ("b", "S", 2.0, "", 1, "repeated"),
        ("c", "S", 3.0, "m", 5, "conflicting"), ("c", "S", 3.5, "", 4, "new"), ("c", "S", 3.5, "m", 4, "conflicting"), ("c", "S", 4.0, "m", 4, "conflicting"),
        ("d", "S", 1.0, "m", 0, "new"),
    ]
    assert [r[STATUS] for r in decide(rows(("a", "S", 1.0, "m", 1), ("a", "S", 1.0, "m", 1))).collect()] == ["new"]


def test_only_touched_partitions_are_listed(spark, tmp_path):
    from sensorlake.operators.dedup import partition_profile
    from sensorlake.sources.warehouse import read_partitions

    root, wh, new = str(tmp_path / "raw"), str(tmp_path / "wh"), str(tmp_path / "new")
    _land(root, 4)
    _land(root, 4, t="pressure")
    ingest_batch(spark, root, wh)
    _land(new, 2, start=10, t="pressure")
    write_pretty(f"{new}/pressure/odd.json", reading(sensor_id="odd", type="pressure", site="A/B=c %d", value=1.0))
    profile = partition_profile(_accepted(spark, new))
    found = read_partitions(spark, wh, profile.partitions)
    assert len(read_warehouse(spark, wh).inputFiles()) == 2 and len(found.inputFiles()) == 1
    assert found.count() == 4 and {r.type for r in found.collect()} == {"pressure"}
    ingest_batch(spark, new, wh)
    assert ingest_batch(spark, new, wh).written == 0  # odd names are found again
    assert read_partitions(spark, wh, [("none", "pressure", 2026, 1, 8)]) is None


@pytest.mark.parametrize("name", ["export_all_query", "run_reports_query", "export_values"])
def test_exports_read_rows_that_were_derived_once(spark, tmp_path, monkeypatch, name):
    """The many reads of the exports are of kept rows; none parses the readings again."""
    from sensorlake import queries

    sources = []

    def noted(fn):
        def run(rows, *args):
            sources.extend(rows.inputFiles())
            return fn(rows, *args)
        return run

    monkeypatch.setattr(queries, "export_all", noted(queries.export_all))
    monkeypatch.setattr(queries, "run_reports", noted(queries.run_reports))
    events = spark.range(40).selectExpr(
        "id AS event_id", "timestamp_ntz'2026-01-08 06:12:07' AS ts", "id AS user_id", "element_at(array('click', 'view', 'purchase'), int(id % 3) + 1) AS event_type", "double(id) AS value"
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    assert getattr(queries, name)(spark, str(tmp_path)).count() > 0
    assert sources and not [f for f in sources if "events.parquet" in f]
