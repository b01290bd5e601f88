"""Files read value by value: no valid reading is lost beside a bad one, in batch and in streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import reading, write_text
from sensorlake import model
from sensorlake.plans.ingest import ingest_batch
from sensorlake.sources.json_files import read_json
from sensorlake.sources.json_values import read_values, recover_types
from sensorlake.sources.warehouse import read_warehouse
from sensorlake.streaming.ingest import start_ingest


def text(i, **more):
    return json.dumps(reading(sensor_id=i, **more))


#: name -> (content, ids of readings, corrupt records with their places)
FILES = {
    "array": (f"[{text('a')},\n {text('b')}]", "ab", []),
    "pretty": (json.dumps([reading(sensor_id="a"), reading(sensor_id="b")], indent=4), "ab", []),
    "behind": (f"{text('a')}{text('b')} {text('c')}", "abc", []),
    "lines": (f"{text('a')}\n{text('b')}\r\n\n", "ab", []),
    "arrays": (f"[{text('a')}]\n[{text('b')}]", "ab", []),
    "mark": ("\ufeff" + text("a"), "a", []),
    "marked array": ("\ufeff[" + text("a") + "]", "a", []),
    "bad element": (f"[{text('a')}, oops, {text('b')}]", "ab", [("oops", 1)]),
    "no value": (f'[{text("a")}, {{"sensor_id": "x", "value": }}, {text("b")}]', "ab", [('{"sensor_id": "x", "value": }', 1)]),
    "cut off": (f'[{text("a")}, {{"sensor_id": "x", "type"', "a", [('{"sensor_id": "x", "type"', 1)]),
    "cut off before another": (f'{{"sensor_id": "x", "si\n{text("a")}', "a", [('{"sensor_id": "x", "si', 0)]),
    "unclosed before another": (f'{{"sensor_id": "x", {text("a")}', "a", [('{"sensor_id": "x"', 0)]),
    "rest": (f"{text('a')} ... and more", "a", [("... and more", 1)]),
    "strings": (text('a}{"', site='S}]{[ \\" \''), ['a}{"'], []),
    "single": ("{'sensor_id': 'a', 'site': 'it\"s }'}", "a", []),
    "nested": (text("a", meta={"x": {"y": [{"z": "}"}]}}), "a", []),
    "open array": (f"[{text('a')}, {text('b')}", "ab", []),
    "empty": ("", "", []),
    "blank": (" \n\t ", "", []),
    "no objects": ("[]", "", []),
    "a number": ("[17]", "", [("17", 0)]),
}


@pytest.mark.parametrize("name", FILES)
def test_values_of_a_file(spark, tmp_path, name):
    content, ids, corrupt = FILES[name]
    rows = read_values(spark, write_text(str(tmp_path / "f" / "a.json"), content)).collect()
    good = [r for r in rows if r[model.CORRUPT_COLUMN] is None]
    assert [r.sensor_id for r in good] == list(ids)
    assert [(r[model.CORRUPT_COLUMN], r[model.SOURCE_PLACE_COLUMN]) for r in rows if r[model.CORRUPT_COLUMN] is not None] == corrupt


@pytest.mark.parametrize("encoding", ["utf-8", "utf-16", "utf-16-le", "utf-16-be", "utf-8-sig"])
def test_encodings(spark, tmp_path, encoding):
    path = write_text(str(tmp_path / "f" / "a.json"), json.dumps([reading(sensor_id="é"), reading(sensor_id="日")], ensure_ascii=False), encoding)
    assert [r.sensor_id for r in read_values(spark, path).collect()] == ["é", "日"]


def test_same_rows_as_the_reader_where_it_reads_all(spark, tmp_path):
    for i in range(5):
        write_text(str(tmp_path / "f" / f"{i}.json"), json.dumps([reading(sensor_id=f"{i}-{j}", value=i + j / 7) for j in range(4)], indent=i))
    write_text(str(tmp_path / "f" / "odd.json"), '[{"sensor_id": 5, "value": 1, "more": [1, {}]}, {"sensor_id": {"a": 1}, "value": NaN}, {"value": "12.5"}, {}]')
    cols = [c for c, _ in model.RAW_FIELDS]
    rows = lambda df: sorted(map(repr, df.select(*cols).collect()))
    assert rows(read_values(spark, str(tmp_path / "f")).filter("value is null or value is not null")) != []
    ours, theirs = read_values(spark, str(tmp_path / "f")), read_json(spark, str(tmp_path / "f"), multi_line=True)
    plain = ours.filter(~F.endswith(model.SOURCE_FILE_COLUMN, F.lit("odd.json")))
    assert rows(plain) == rows(theirs.filter(~F.endswith(model.SOURCE_FILE_COLUMN, F.lit("odd.json"))))
    odd = [(r.sensor_id, r.value) for r in ours.filter(F.endswith(model.SOURCE_FILE_COLUMN, F.lit("odd.json"))).collect()]
    assert odd[0] == ("5", 1.0) and odd[1][0].replace(" ", "") == '{"a":1}' and odd[1][1] != odd[1][1] and odd[2:] == [(None, None), (None, None)]


def test_a_long_damaged_file(spark, tmp_path):
    """Thousands of objects, some of them open: no stack overflow, nothing lost."""
    parts = [text(str(i)) if i % 50 else '{"sensor_id": "open", ' for i in range(3000)]
    rows = read_values(spark, write_text(str(tmp_path / "f" / "a.json"), "[" + ",".join(parts) + "]")).collect()
    assert sum(r[model.CORRUPT_COLUMN] is None for r in rows) == 2940 and sum(r[model.CORRUPT_COLUMN] is not None for r in rows) == 60
    one = text("x" * 3_000_000, site="[{" * 100_000)
    assert len(read_values(spark, write_text(str(tmp_path / "g" / "a.json"), one)).first().sensor_id) == 3_000_000


def land(root):
    write_text(f"{root}/temperature/nan.json", "[" + ", ".join([text("n1"), text("n2").replace("42.5", "NaN"), text("n3")]) + "]")
    write_text(f"{root}/temperature/bom.json", "\ufeff" + text("b1"))
    write_text(f"{root}/temperature/five.json", " ".join(text(f"f{i}") for i in range(5)))
    write_text(f"{root}/pressure/bad.json", f"[{text('p1', type='pressure')}, {{\"sensor_id\": \"p2\", }}, {text('p3', type='pressure')}]")


def ids(spark, wh):
    return sorted(r.sensor_id for r in read_warehouse(spark, wh).collect())


STORED = ["b1", "f0", "f1", "f2", "f3", "f4", "n1", "n3", "p1", "p3"]


def rejected(spark, qu):
    return sorted((r.sensor_id or "", ",".join(r.reject_reasons[:1]), r[model.SOURCE_PLACE_COLUMN]) for r in spark.read.parquet(qu).collect())


def test_batch_stores_all_valid_readings(spark, tmp_path):
    root, wh, qu = (str(tmp_path / n) for n in ("raw", "wh", "qu"))
    land(root)
    report = ingest_batch(spark, root, wh, quarantine_path=qu, multi_line=True)
    assert (report.total, report.valid, report.rejected, report.quarantined) == (12, 10, 2, 2)
    assert ids(spark, wh) == STORED
    assert rejected(spark, qu) == [("", "corrupt_record", 1), ("n2", "nan_value", 1)] or rejected(spark, qu) == [("n2", "nan_value", 1), ("p2", "corrupt_record", 1)]
    assert ingest_batch(spark, root, wh, quarantine_path=qu, multi_line=True).quarantined == 0


def test_stream_stores_all_valid_readings(spark, tmp_path):
    root, wh, qu, ck = (str(tmp_path / n) for n in ("raw", "wh", "qu", "ck"))
    land(root)
    start_ingest(spark, root, wh, ck, multi_line=True, quarantine_path=qu, available_now=True, max_files_per_trigger=1).awaitTermination()
    assert ids(spark, wh) == STORED and len(rejected(spark, qu)) == 2


@pytest.mark.parametrize("multi_line", [True, False])
def test_values_sent_as_text(spark, tmp_path, multi_line):
    root, wh, qu = (str(tmp_path / n) for n in ("raw", "wh", "qu"))
    said = {"text": "12.5", "spaces": " 3 ", "word": "hot", "object": {"x": 1}, "truth": True, "list": [1], "negative": "-1", "number": 7.0}
    write_text(f"{root}/temperature/a.json", "\n".join(json.dumps(reading(sensor_id=k, value=v)) for k, v in said.items()))
    report = ingest_batch(spark, root, wh, quarantine_path=qu, multi_line=multi_line, typed_recovery=True)
    assert {r.sensor_id: r.value for r in read_warehouse(spark, wh).collect()} == {"text": 12.5, "spaces": 3.0, "number": 7.0}
    reasons = {r.sensor_id: r.reject_reasons for r in spark.read.parquet(qu).collect()}
    assert reasons.pop("negative") == ["negative_value"]
    assert report.rejected == 5 and all(r == ["corrupt_record", "value_missing"] for r in reasons.values()) and len(reasons) == 4
    wh2 = str(tmp_path / "wh2")
    assert ingest_batch(spark, root, wh2, multi_line=multi_line).written == 1  # without recovery, as before


def test_recovery_leaves_other_rows_alone(spark, tmp_path):
    path = write_text(str(tmp_path / "f" / "a.json"), text("a") + "\nnot json\n")
    raw = read_json(spark, path, multi_line=False)
    assert sorted(map(repr, recover_types(raw).collect())) == sorted(map(repr, raw.collect()))
    assert recover_types(raw).columns == raw.columns and os.path.exists(path)
