"""Nothing is lost, counted twice or left stale: identity, repeats, overwrite, compaction, views, old files."""

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import reading, write_pretty, write_text
from sensorlake import model
from sensorlake.operators import reports
from sensorlake.operators.derive import to_warehouse
from sensorlake.operators.summary import merge_summaries, reading_summary
from sensorlake.plans.ingest import ingest_batch, ingest_frame, merge_late
from sensorlake.sinks import warehouse as sink
from sensorlake.sources.warehouse import read_warehouse
from sensorlake.streaming.ingest import read_alerts, start_ingest
from sensorlake.streaming.latest import finished, read_latest, read_summary, update_summary


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f, _ in model.RAW_FIELDS) for r in rows], model.RAW_SCHEMA)


def stored(spark, wh):
    return sorted((r.sensor_id, r.site, r.value) for r in read_warehouse(spark, wh).collect())


def test_one_identity_in_one_batch_and_in_two(spark, tmp_path):
    a, b = reading(sensor_id="x", site="S1"), reading(sensor_id="x", site="S2")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    ingest_frame(frame(spark, [a, b]), one)
    ingest_frame(frame(spark, [a]), two)
    ingest_frame(frame(spark, [b]), two)
    assert stored(spark, one) == stored(spark, two) == [("x", "S1", a["value"]), ("x", "S2", b["value"])]


def test_repeats_are_counted_and_conflicts_go_to_the_quarantine(spark, tmp_path):
    wh, qu = str(tmp_path / "wh"), str(tmp_path / "qu")
    first, later = reading(sensor_id="x", timestamp="2026-01-08T10:00:00"), reading(sensor_id="x", timestamp="2026-01-08T11:00:00")
    report = ingest_frame(frame(spark, [later, first, first, reading(sensor_id="y")]), wh, quarantine_path=qu)
    assert (report.valid, report.written, report.repeated, report.conflicting, report.quarantined) == (4, 2, 1, 1, 1)
    assert read_warehouse(spark, wh).filter("sensor_id = 'x'").first().hour == 10  # the earliest stays
    other = reading(sensor_id="x", value=1.0)
    report = ingest_frame(frame(spark, [other, first]), wh, quarantine_path=qu)
    assert (report.written, report.repeated, report.conflicting, report.quarantined) == (0, 1, 1, 1)
    assert report.frame(spark).first().repeated == 1
    assert {tuple(r.reject_reasons) for r in spark.read.parquet(qu).collect()} == {("repeated_id_with_other_content",)}


def test_quarantine_counts_every_rejected_line(spark, tmp_path):
    root, wh, qu = str(tmp_path / "raw"), str(tmp_path / "wh"), str(tmp_path / "qu")
    write_text(f"{root}/temperature/a.json", "oops\noops\noops\nother\nother\n")
    report = ingest_batch(spark, root, wh, quarantine_path=qu, multi_line=False)
    assert report.rejected == report.quarantined == 5
    assert sorted(r.occurrences for r in spark.read.parquet(qu).collect()) == [2, 3]


def test_overwrite_without_a_valid_row_changes_nothing(spark, tmp_path):
    wh = str(tmp_path / "wh")
    ingest_frame(frame(spark, [reading(sensor_id="a"), reading(sensor_id="b")]), wh)
    report = ingest_frame(frame(spark, [reading(sensor_id="c", value=-1.0)]), wh, mode="overwrite")
    assert report.written == 0 and len(stored(spark, wh)) == 2
    assert sink.write_warehouse(read_warehouse(spark, wh).limit(0), wh, "overwrite").written == 0


def test_rows_appended_during_compaction_stay(spark, tmp_path, monkeypatch):
    wh = str(tmp_path / "wh")
    for i in range(4):
        ingest_frame(frame(spark, [reading(sensor_id=f"r{i}")]), wh)
    real = sink.write_warehouse

    def slow(df, path, mode="append", fmt="parquet", writers=None):
        monkeypatch.setattr(sink, "write_warehouse", real)
        ingest_frame(frame(spark, [reading(sensor_id="meanwhile")]), wh)
        return real(df, path, mode, fmt, writers)

    monkeypatch.setattr(sink, "write_warehouse", slow)
    assert sink.compact(spark, wh) == 4
    assert [s for s, _, _ in stored(spark, wh)] == ["meanwhile", "r0", "r1", "r2", "r3"]


def test_a_failed_compaction_keeps_the_files(spark, tmp_path, monkeypatch):
    wh = str(tmp_path / "wh")
    for i in range(3):
        ingest_frame(frame(spark, [reading(sensor_id=f"r{i}")]), wh)

    def broken(*args, **kwargs):
        raise OSError("disk full")

    monkeypatch.setattr(sink, "write_warehouse", broken)
    with pytest.raises(OSError):
        sink.compact(spark, wh, days=read_warehouse(spark, wh))
    assert len(stored(spark, wh)) == 3


def test_compaction_takes_small_files_of_the_given_days_in_portions(spark, tmp_path, monkeypatch):
    wh = str(tmp_path / "wh")
    for day in (1, 2, 3):
        for i in range(3):
            ingest_frame(frame(spark, [reading(sensor_id=f"{day}-{i}", site="A/B %d", timestamp=f"2026-01-0{day}T10:00:00")]), wh)
    ingest_frame(frame(spark, [reading(sensor_id="alone", timestamp="2026-01-09T10:00:00")]), wh)
    files = lambda: sorted(f.split("day=")[1].split("/")[0] for f in read_warehouse(spark, wh).inputFiles())
    before = stored(spark, wh)
    assert sink.compact(spark, wh, small=1) == 0 and len(files()) == 10
    monkeypatch.setattr(sink, "FILES_AT_ONCE", 2)
    some = read_warehouse(spark, wh).filter("day < 3").select("year", "month", "day")
    assert sink.compact(spark, wh, days=some) == 6 and files() == ["1", "2", "3", "3", "3", "9"]
    assert sink.compact(spark, wh) == 3 and files() == ["1", "2", "3", "9"] and stored(spark, wh) == before


def land(root, rows, name, age_days=0):
    path = write_pretty(f"{root}/temperature/{name}.json", rows)
    if age_days:
        then = time.time() - 86400 * age_days
        os.utime(path, (then, then))


def test_old_dated_files_are_read(spark, tmp_path):
    root, wh, ck = (str(tmp_path / n) for n in ("raw", "wh", "ck"))
    land(root, reading(sensor_id="new"), "a")
    start_ingest(spark, root, wh, ck, multi_line=True, available_now=True).awaitTermination()
    land(root, reading(sensor_id="old"), "b", age_days=30)
    start_ingest(spark, root, wh, ck, multi_line=True, available_now=True).awaitTermination()
    assert [s for s, _, _ in stored(spark, wh)] == ["new", "old"]


def test_all_outputs_show_what_the_table_received(spark, tmp_path):
    """Every file twice, one per batch; then a new checkpoint over the same views."""
    root, wh, summary, latest, alerts = (str(tmp_path / n) for n in ("raw", "wh", "summary", "latest", "alerts"))
    options = dict(multi_line=True, available_now=True, max_files_per_trigger=1, summary_path=summary, latest_path=latest, alerts_path=alerts)
    for i in range(3):
        for copy in range(2):
            land(root, reading(sensor_id=f"r{i}", value=80.0 + 5 * i, timestamp=f"2026-01-0{i + 1}T10:00:00"), f"r{i}-{copy}")
    start_ingest(spark, root, wh, str(tmp_path / "ck1"), **options).awaitTermination()
    for i in range(3, 5):
        land(root, reading(sensor_id=f"r{i}", value=80.0 + 5 * i), f"r{i}")
    start_ingest(spark, root, wh, str(tmp_path / "ck2"), **options).awaitTermination()
    table = read_warehouse(spark, wh)
    assert table.count() == 5
    kept = read_summary(spark, summary)
    assert reports.stats_by_type(kept).collect() == reports.stats_by_type(table).collect()
    assert sorted(r.sensor_id for r in read_alerts(spark, alerts).collect()) == ["r2", "r3", "r4"]
    assert read_latest(spark, latest).collect() == reports.latest_readings(table).collect()
    assert len(finished(spark, latest)) <= 2


def test_a_trigger_rewrites_only_the_days_it_touches(spark, tmp_path):
    path = str(tmp_path / "summary")
    rows = [reading(sensor_id=f"d{d}", timestamp=f"2026-01-{d:02d}T10:00:00") for d in range(1, 8)]
    assert len(update_summary(to_warehouse(frame(spark, rows)), path, "s", 0)) == 7
    before = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("_day=")}
    late = to_warehouse(frame(spark, [reading(sensor_id="again", timestamp="2026-01-03T10:30:00")]))
    assert update_summary(late, path, "s", 1) == ["2026-01-03"]
    assert update_summary(late, path, "s", 1) == []  # a replay
    after = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("_day=")}
    assert [d for d in after if after[d] != before[d]] == ["_day=2026-01-03"]
    assert reports.stats_by_type(read_summary(spark, path)).first().total_mesures == 8


def test_rows_behind_the_watermark_are_merged_and_counted(spark, tmp_path):
    root, wh = str(tmp_path / "raw"), str(tmp_path / "wh")
    options = dict(multi_line=True, available_now=True, max_files_per_trigger=1, dedup="state", dedup_delay="1 hour")
    for i, day in enumerate((20, 21, 1)):
        land(root, reading(sensor_id=f"r{i}", timestamp=f"2026-01-{day:02d}T10:00:00"), f"r{i}")
        start_ingest(spark, root, wh, str(tmp_path / "ck"), **options).awaitTermination()
    late = merge_late(spark, root, wh, multi_line=True)
    assert [s for s, _, _ in stored(spark, wh)] == ["r0", "r1", "r2"] and late in (0, 1)
    assert merge_late(spark, root, wh, multi_line=True) == 0


def test_state_mode_accounts_for_conflicts_rejected_and_late_rows(spark, tmp_path):
    root, wh, qu, metrics, alerts, latest, summary = (str(tmp_path / n) for n in ("raw", "wh", "qu", "metrics", "alerts", "latest", "summary"))
    views = dict(quarantine_path=qu, alerts_path=alerts, latest_path=latest, summary_path=summary)
    options = dict(multi_line=True, available_now=True, max_files_per_trigger=1, dedup="state", dedup_delay="1 hour", metrics_path=metrics, **views)
    day = "2026-01-08T1{}:00:00".format
    files = [
        reading(sensor_id="x", value=20.0, timestamp=day(0)),
        reading(sensor_id="x", value=21.0, timestamp=day(0)),  # a conflict of one time
        reading(sensor_id="x", value=22.0, timestamp=day(1)),
        reading(sensor_id="x", value=20.0, timestamp=day(0)),  # a repeat
        reading(sensor_id="old", value=-1.0, timestamp="2026-01-01T10:00:00"),
        reading(sensor_id="bad", timestamp="no time"),
        reading(sensor_id="y", value=20.0, timestamp=day(1)),  # its watermark is not moved by the row before
        reading(sensor_id="z", value=99.0, timestamp="2026-01-02T10:00:00"),
        reading(sensor_id="y", value=23.0, timestamp="2026-01-08T09:00:00"),  # a late conflict
    ]
    for i, row in enumerate(files):
        land(root, row, f"r{i}")
        os.utime(f"{root}/temperature/r{i}.json", (1_760_000_000 + i, 1_760_000_000 + i))
    start_ingest(spark, root, wh, str(tmp_path / "ck"), **options).awaitTermination()
    assert [(s, v) for s, _, v in stored(spark, wh)] == [("x", 20.0), ("y", 20.0)]
    reasons = lambda: sorted((r.sensor_id, r.value, *r.reject_reasons) for r in spark.read.parquet(qu).collect())
    conflict, met = "repeated_id_with_other_content", [("bad", 20.0, "timestamp_unreadable"), ("old", -1.0, "negative_value")]
    met = [(i, reading()["value"] if i == "bad" else v, r) for i, v, r in met]
    assert reasons() == sorted([*met, ("x", 21.0, conflict), ("x", 22.0, conflict)])
    sums = spark.read.parquet(metrics).agg(*[F.sum(c) for c in ("rows_read", "rows_valid", "rows_rejected", "rows_written")]).first()
    assert tuple(sums) in ((6, 4, 2, 2), (7, 5, 2, 2))  # the repeat is behind the watermark or known to the state
    assert merge_late(spark, root, wh, multi_line=True, **views) == 1
    assert [(s, v) for s, _, v in stored(spark, wh)] == [("x", 20.0), ("y", 20.0), ("z", 99.0)]
    assert reasons() == sorted([*met, ("x", 21.0, conflict), ("x", 22.0, conflict), ("y", 23.0, conflict)])
    assert [r.sensor_id for r in read_alerts(spark, alerts).collect()] == ["z"]
    assert reports.stats_by_type(read_summary(spark, summary)).first().total_mesures == read_latest(spark, latest).count() == 3
    assert merge_late(spark, root, wh, multi_line=True, **views) == 0
    assert reports.stats_by_type(read_summary(spark, summary)).first().total_mesures == 3 and len(reasons()) == 5


@pytest.mark.parametrize("place", ["alerts", "summary", "table"])
def test_a_merge_that_failed_counts_nothing_twice(spark, tmp_path, monkeypatch, place):
    """It fails before or behind the views, more late files land, and it is run again."""
    from sensorlake.plans import ingest as plan
    from sensorlake.streaming import ingest as stream, latest as kept

    root, wh, alerts, summary = (str(tmp_path / n) for n in ("raw", "wh", "alerts", "summary"))
    options = dict(multi_line=True, alerts_path=alerts, summary_path=summary)
    land(root, reading(sensor_id="a", value=99.0), "a")
    module, name = {"alerts": (stream, "write_alerts"), "summary": (kept, "update_summary"), "table": (plan, "write_warehouse")}[place]

    def broken(*args, **kwargs):
        raise OSError("crash")

    monkeypatch.setattr(module, name, broken)
    with pytest.raises(OSError):
        merge_late(spark, root, wh, **options)
    monkeypatch.undo()
    land(root, [reading(sensor_id="b", value=98.0), reading(sensor_id="c")], "b")
    assert merge_late(spark, root, wh, **options) == 3
    assert [s for s, _, _ in stored(spark, wh)] == ["a", "b", "c"]
    assert sorted(r.sensor_id for r in read_alerts(spark, alerts).collect()) == ["a", "b"]
    assert reports.stats_by_type(read_summary(spark, summary)).first().total_mesures == 3
    assert merge_late(spark, root, wh, **options) == 0
    assert reports.stats_by_type(read_summary(spark, summary)).first().total_mesures == 3


def test_markers_of_the_summary_do_not_pile_up(spark, tmp_path):
    path = str(tmp_path / "summary")
    for i in range(6):
        update_summary(to_warehouse(frame(spark, [reading(sensor_id=f"r{i}")])), path, "s", i)
    (day,) = (d for d in os.listdir(path) if d.startswith("_day="))
    assert len([n for n in os.listdir(f"{path}/{day}") if n.startswith(("v=", "_done"))]) == 4
    assert reports.stats_by_type(read_summary(spark, path)).first().total_mesures == 6


def test_a_missing_source_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        start_ingest(spark, str(tmp_path / "none"), str(tmp_path / "wh"), str(tmp_path / "ck"), multi_line=True)


def test_a_zone_with_offset_changes_is_refused(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError):
            ingest_frame(frame(spark, [reading()]), str(tmp_path / "wh"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture
def large(spark):
    rows = [reading(sensor_id=f"v{i}", value=v) for i, v in enumerate([1e13, 1.0, 2.5, 3.0])]
    return to_warehouse(frame(spark, [*rows, reading(sensor_id="inf", value=float("inf"))]))


def test_large_values_in_reports_and_summary(spark, large):
    row = reports.stats_by_type(large).first()
    assert (row.total_mesures, row.valeur_min, row.valeur_max) == (4, 1.0, 1e13)
    assert row.valeur_moyenne == pytest.approx((1e13 + 6.5) / 4)
    for summary in (reading_summary(large), merge_summaries(reading_summary(large))):
        assert reports.stats_by_type(summary).first() == row


def test_deviation_around_a_large_mean(spark):
    rows = spark.range(20_000).select(
        F.col("id").cast("string").alias("sensor_id"), F.lit("vibration").alias("type"), F.round(F.lit(1e6) + F.randn(3) * 0.05, 3).alias("value"),
        F.lit("mm/s").alias("unit"), F.lit("S").alias("site"), F.lit("M").alias("machine"),
        F.concat(F.lit("2026-01-01T"), F.lpad((F.col("id") % 24).cast("string"), 2, "0"), F.lit(":00:00")).alias("timestamp"),
    )
    table = to_warehouse(rows)
    assert reports.vibration_top5(table).first().ecart_type == reports.vibration_top5(reading_summary(table)).first().ecart_type == 0.05


def test_whole_numbers_are_no_drift(spark):
    from pyspark.sql import types as T

    from sensorlake.operators.quality import schema_drift

    def inferred(t):
        return T.StructType([T.StructField(n, t if n == "value" else f) for n, f in model.RAW_FIELDS])

    rows = schema_drift(spark, model.RAW_SCHEMA, {"temperature": inferred(T.LongType()), "pressure": inferred(T.StringType())}).collect()
    assert [(r.sensor_type, r.column_name, r.issue) for r in rows] == [("pressure", "value", "type_differs")]
