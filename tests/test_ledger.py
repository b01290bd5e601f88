"""The ledger of read files: unchanged files are not opened again, changed ones are, half-written ones are healed."""

import json
import os
import time

from conftest import reading, write_text
from sensorlake.plans import ingest
from sensorlake.plans.ingest import ingest_batch, second_look
from sensorlake.sources.ledger import landed_files, read_ledger, unread_files, with_healed
from sensorlake.sources.warehouse import read_warehouse
from sensorlake.streaming.ingest import start_ingest


def put(root, name, rows, half=False, age=0):
    content = json.dumps(rows)
    path = write_text(f"{root}/temperature/{name}.json", content[: len(content) // 2 + 20] if half else content)
    then = time.time() - age
    os.utime(path, (then, then))
    return path


def rows_of(*ids):
    return [reading(sensor_id=i) for i in ids]


def stored(spark, wh):
    return sorted(r.sensor_id for r in read_warehouse(spark, wh).collect())


def test_unchanged_files_are_not_opened_again(spark, tmp_path, monkeypatch):
    root, wh, ledger = (str(tmp_path / n) for n in ("raw dir", "wh", "ledger"))
    put(root, "a", rows_of("1", "2"), age=50)
    put(root, "b", rows_of("3"), age=50)
    options = dict(multi_line=True, ledger_path=ledger)
    assert ingest_batch(spark, root, wh, **options).total == 3
    opened, real = [], ingest._read
    monkeypatch.setattr(ingest, "_read", lambda s, paths, *a: (opened.append(sorted(map(os.path.basename, paths))), real(s, paths, *a))[1])
    assert ingest_batch(spark, root, wh, **options).total == 0 and opened == []
    put(root, "a", rows_of("1", "2", "4"), age=20)  # written again, longer
    put(root, "c", rows_of("5"))
    report = ingest_batch(spark, root, wh, **options)
    assert (report.total, report.written, report.repeated) == (4, 2, 2) and opened == [["a.json", "c.json"]]
    assert stored(spark, wh) == ["1", "2", "3", "4", "5"]
    noted = {(os.path.basename(r.path), r.rows, r.corrupt) for r in read_ledger(spark, ledger).collect()}
    assert noted == {("a.json", 2, 0), ("b.json", 1, 0), ("a.json", 3, 0), ("c.json", 1, 0)}
    assert unread_files(spark, [f"{root}/temperature"], ledger).count() == 0 and landed_files(spark, f"{root}/temperature").count() == 3


def test_listing_opens_no_file(spark, tmp_path):
    put(str(tmp_path), "a", rows_of("1"))
    plan = landed_files(spark, str(tmp_path / "temperature"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_a_run_that_fails_reads_its_files_again(spark, tmp_path, monkeypatch):
    root, wh, ledger = (str(tmp_path / n) for n in ("raw", "wh", "ledger"))
    put(root, "a", rows_of("1", "2"))

    def broken(*args):
        raise OSError("lost")

    monkeypatch.setattr(ingest, "note_files", broken)
    try:
        ingest_batch(spark, root, wh, multi_line=True, ledger_path=ledger)
        raise AssertionError("the error must be seen")
    except OSError:
        pass
    monkeypatch.undo()
    report = ingest_batch(spark, root, wh, multi_line=True, ledger_path=ledger)
    assert (report.total, report.written) == (2, 0) and stored(spark, wh) == ["1", "2"]


def test_empty_and_corrupt_files_are_noted(spark, tmp_path):
    root, wh, qu, ledger = (str(tmp_path / n) for n in ("raw", "wh", "qu", "ledger"))
    write_text(f"{root}/temperature/none.json", "[]")
    write_text(f"{root}/temperature/empty.json", "")
    write_text(f"{root}/temperature/bad.json", "oops")
    assert ingest_batch(spark, root, wh, quarantine_path=qu, multi_line=True, ledger_path=ledger).rejected == 1
    assert {(os.path.basename(r.path), r.rows, r.corrupt) for r in read_ledger(spark, ledger).collect()} == {("none.json", 0, 0), ("bad.json", 1, 1)}
    assert ingest_batch(spark, root, wh, quarantine_path=qu, multi_line=True, ledger_path=ledger).total == 0


def test_a_half_written_file_is_ingested_once_it_is_complete_in_batches(spark, tmp_path):
    root, wh, qu, ledger = (str(tmp_path / n) for n in ("raw", "wh", "qu", "ledger"))
    put(root, "a", rows_of("1", "2"), half=True, age=60)
    options = dict(multi_line=True, ledger_path=ledger, quarantine_path=qu)
    assert ingest_batch(spark, root, wh, **options).rejected == 1
    put(root, "a", rows_of("1", "2"))
    put(root, "b", rows_of("3"), half=True)
    ingest_batch(spark, root, wh, **options)
    assert stored(spark, wh)[:2] == ["1", "2"]
    marked = {(os.path.basename(r.source_file), r.healed) for r in with_healed(spark.read.parquet(qu), read_ledger(spark, ledger)).collect()}
    assert marked == {("a.json", True), ("b.json", False)}
    assert ingest_batch(spark, root, wh, **options).total == 0


def test_a_half_written_file_is_ingested_once_it_is_complete_in_streams(spark, tmp_path):
    root, wh, qu, ck, ledger = (str(tmp_path / n) for n in ("raw", "wh", "qu", "ck", "ledger"))
    put(root, "a", rows_of("1", "2", "3", "4"), half=True, age=60)
    put(root, "b", rows_of("5"), age=60)
    look = lambda: second_look(spark, root, wh, qu, ledger, multi_line=True)
    assert look().total == 0  # nothing in quarantine yet
    start = lambda: start_ingest(spark, root, wh, ck, multi_line=True, quarantine_path=qu, available_now=True).awaitTermination()
    start()
    assert look().total == 0
    put(root, "a", rows_of("1", "2", "3", "4"))
    start()  # the file source has read that file
    assert stored(spark, wh) != ["1", "2", "3", "4", "5"]
    report = look()
    assert report.total == 4 and stored(spark, wh) == ["1", "2", "3", "4", "5"]
    assert look().total == 0
    assert [r.healed for r in with_healed(spark.read.parquet(qu), read_ledger(spark, ledger)).collect()] == [True]
