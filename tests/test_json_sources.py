"""JSON files with the declared schema (FIXTURES §5)."""

import json
import math
import os


from sensorlake import model
from sensorlake.operators import quality
from sensorlake.operators.cleaning import normalise, with_reject_reasons
from sensorlake.sources.json_files import infer_schema, read_json, read_sensor_dirs, sensor_dirs, stream_json

from conftest import reading, write_pretty, write_text


def _read(spark, path, multi_line=True):
    return read_json(spark, path, multi_line=multi_line)


def test_pretty_printed_object(spark, tmp_path):
    p = write_pretty(str(tmp_path / "t" / "ok.json"), reading(type=" Temperature "))
    rows = _read(spark, p).collect()
    assert len(rows) == 1 and rows[0][model.CORRUPT_COLUMN] is None
    assert rows[0][model.SOURCE_FILE_COLUMN].endswith("ok.json")


def test_array_gives_one_row_per_element(spark, tmp_path):
    p = write_text(str(tmp_path / "a" / "arr.json"), json.dumps([reading(sensor_id="a"), reading(sensor_id="b")], indent=2))
    assert sorted(r.sensor_id for r in _read(spark, p).collect()) == ["a", "b"]


def test_truncated_file_is_corrupt(spark, tmp_path):
    p = write_text(str(tmp_path / "b" / "bad.json"), '{"sensor_id": "x", ')
    rows = _read(spark, p).collect()
    assert len(rows) == 1 and rows[0][model.CORRUPT_COLUMN] is not None
    assert rows[0].sensor_id is None


def test_string_and_text_values_are_corrupt(spark, tmp_path):
    write_pretty(str(tmp_path / "s" / "str.json"), reading(sensor_id="s1", value="12.5"))
    write_pretty(str(tmp_path / "s" / "hot.json"), reading(sensor_id="s2", value="hot"))
    rows = _read(spark, str(tmp_path / "s")).collect()
    assert len(rows) == 2
    assert all(r.value is None and r[model.CORRUPT_COLUMN] is not None for r in rows)
    reasons = with_reject_reasons(normalise(_read(spark, str(tmp_path / "s")))).collect()
    assert all("corrupt_record" in r.reject_reasons for r in reasons)


def test_nan_value_parses_then_is_rejected(spark, tmp_path):
    text = json.dumps(reading(), indent=2).replace('"value": 42.5', '"value": NaN')
    p = write_text(str(tmp_path / "n" / "nan.json"), text)
    row = with_reject_reasons(normalise(_read(spark, p))).first()
    assert math.isnan(row.value)
    assert row.reject_reasons == ["nan_value"]


def test_extra_field_ignored_and_reported(spark, tmp_path):
    p = write_pretty(str(tmp_path / "e" / "extra.json"), {**reading(), "foo": 1})
    rows = _read(spark, p).collect()
    assert len(rows) == 1 and rows[0][model.CORRUPT_COLUMN] is None
    drift = quality.schema_drift(spark, model.RAW_SCHEMA, {"temperature": infer_schema(spark, p)}).collect()
    assert [(r.column_name, r.issue) for r in drift] == [("foo", "extra")]


def test_missing_fields_are_null_and_drift_reported(spark, tmp_path):
    p = write_pretty(str(tmp_path / "m" / "missing.json"), {"sensor_id": "m", "type": "pressure"})
    row = with_reject_reasons(normalise(_read(spark, p))).first()
    assert row.reject_reasons == ["value_missing", "site_missing", "machine_missing", "timestamp_missing"]
    drift = {r.column_name: r.issue for r in quality.schema_drift(spark, model.RAW_SCHEMA, {"temperature": infer_schema(spark, p)}).collect()}
    assert drift == {"value": "missing", "unit": "missing", "site": "missing", "machine": "missing", "timestamp": "missing"}


def test_ndjson_multiline_modes(spark, tmp_path):
    text = json.dumps(reading(sensor_id="1")) + "\n" + json.dumps(reading(sensor_id="2")) + "\n"
    p = write_text(str(tmp_path / "j" / "two.json"), text)
    assert [r.sensor_id for r in _read(spark, p, multi_line=True).collect()] == ["1"]
    assert sorted(r.sensor_id for r in _read(spark, p, multi_line=False).collect()) == ["1", "2"]


def test_pretty_printed_read_line_by_line_is_all_corrupt(spark, tmp_path):
    p = write_pretty(str(tmp_path / "l" / "pretty.json"), reading())
    rows = _read(spark, p, multi_line=False).collect()
    assert len(rows) == 9
    assert all(r[model.CORRUPT_COLUMN] is not None for r in rows)


def test_empty_file_gives_no_rows(spark, tmp_path):
    p = write_text(str(tmp_path / "z" / "empty.json"), "")
    assert _read(spark, p).count() == 0


def test_bom_file_reads_and_is_flagged(spark, tmp_path):
    p = write_text(str(tmp_path / "bom" / "bom.json"), "﻿" + json.dumps(reading(), indent=2))
    write_pretty(str(tmp_path / "bom" / "plain.json"), reading(sensor_id="plain"))
    rows = _read(spark, str(tmp_path / "bom")).collect()
    assert len(rows) == 2 and all(r[model.CORRUPT_COLUMN] is None for r in rows)
    flags = {os.path.basename(r.path): r.has_bom for r in quality.bom_check(spark, str(tmp_path / "bom")).collect()}
    assert flags == {"bom.json": True, "plain.json": False}


def test_only_json_suffix_read_batch_and_stream(spark, tmp_path):
    d = tmp_path / "suffix" / "temperature"
    write_pretty(str(d / "a.json"), reading(sensor_id="a"))
    write_pretty(str(d / "b.JSON"), reading(sensor_id="b"))
    write_pretty(str(d / "c.txt"), reading(sensor_id="c"))
    write_pretty(str(d / "d.json.tmp"), reading(sensor_id="d"))
    assert [r.sensor_id for r in read_sensor_dirs(spark, str(tmp_path / "suffix"), multi_line=True).collect()] == ["a"]
    q = (
        stream_json(spark, str(d), multi_line=True)
        .select("sensor_id")
        .writeStream.format("memory")
        .queryName("suffix_check")
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    assert [r.sensor_id for r in spark.sql("SELECT * FROM suffix_check").collect()] == ["a"]


def test_directory_discovery_skips_missing_and_empty(spark, tmp_path):
    write_pretty(str(tmp_path / "root" / "vibration" / "v.json"), reading(type="vibration"))
    os.makedirs(tmp_path / "root" / "pressure")
    assert [os.path.basename(d) for d in sensor_dirs(spark, str(tmp_path / "root"))] == ["vibration"]
    assert read_sensor_dirs(spark, str(tmp_path / "nothing"), multi_line=True) is None


def test_corrupt_records_and_null_profile(spark, tmp_path):
    write_pretty(str(tmp_path / "q" / "ok.json"), reading(sensor_id="ok"))
    write_text(str(tmp_path / "q" / "bad.json"), '{"sensor_id": ')
    df = _read(spark, str(tmp_path / "q"))
    bad = quality.corrupt_records(df).collect()
    assert len(bad) == 1 and bad[0][model.SOURCE_FILE_COLUMN].endswith("bad.json")
    nulls = {r.column_name: r.null_count for r in quality.null_profile(df).collect()}
    assert nulls["sensor_id"] == 1 and nulls[model.CORRUPT_COLUMN] == 1
    by_type = {r.type: (r.total, r.with_sensor_id, r.valid) for r in quality.valid_by_type(normalise(df)).collect()}
    assert by_type == {"temperature": (1, 1, 1), None: (1, 0, 0)}
    reasons = {r.reason: r.n for r in quality.reject_reason_counts(normalise(df)).collect()}
    assert reasons["corrupt_record"] == 1 and reasons["sensor_id_missing"] == 1
    assert quality.sample_rows(df, 1).count() == 1


def test_field_drift_by_type_and_file(spark, tmp_path):
    lines = [
        json.dumps(reading(sensor_id="1")), json.dumps(reading(sensor_id="2", value="3.5")), json.dumps(reading(sensor_id="3", value=4, firmware={"v": 1})),
        json.dumps({"sensor_id": None, "type": "temperature"}), "{}", "no json", "[1]", "", '{"value": null, "unit": 5}',
    ]
    write_text(str(tmp_path / "temperature" / "b.json"), "\n".join(lines))
    write_text(str(tmp_path / "temperature" / "a.json"), json.dumps(reading(value={"is": 1})) + "\n" + json.dumps(reading(value="x")))
    write_text(str(tmp_path / "pressure" / "c.json"), json.dumps(reading(type="pressure")))
    drift = quality.field_drift(quality.reading_texts(spark, [str(tmp_path / "temperature"), str(tmp_path / "pressure")]))
    assert drift._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {(r.sensor_type, r.column_name, r.issue, r.found_type): (r.readings, r.declared_type, os.path.basename(r.first_file)) for r in drift.collect()}
    missing = {c: n for c, n in (("sensor_id", 2), ("type", 2), ("value", 2), ("unit", 2), ("site", 3), ("machine", 3), ("timestamp", 3))}
    want = {("temperature", c, "missing", None): (n, "double" if c == "value" else "string", "b.json") for c, n in missing.items()}
    want |= {
        ("temperature", "value", "type_differs", "STRING"): (2, "double", "a.json"),
        ("temperature", "value", "type_differs", "OBJECT<is: BIGINT>"): (1, "double", "a.json"),
        ("temperature", "unit", "type_differs", "BIGINT"): (1, "string", "b.json"),
        ("temperature", "firmware", "extra", "OBJECT<v: BIGINT>"): (1, None, "b.json"),
        ("temperature", "", "unreadable", None): (2, None, "b.json"),
    }
    assert got == want
