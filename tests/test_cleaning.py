"""Cleaning, validation, alert thresholds (FIXTURES §2)."""

import math

import pytest
from pyspark.sql import functions as F

from sensorlake import model
from sensorlake.functions import alert_flag
from sensorlake.operators.cleaning import normalise, validate, with_reject_reasons
from sensorlake.operators.derive import to_warehouse

from conftest import reading

THRESHOLD_CASES = [
    ("temperature", [0.0, 20.0, 85.0], [85.01, 120.0], [-0.01, None, math.nan]),
    ("vibration", [0.0, 4.5, 7.0], [7.001, 15.0], [-0.001, None, math.nan]),
    ("pressure", [0.5, 1.0, 6.0], [0.0, 0.49, 6.01, 10.0], [-0.01, None, math.nan]),
]


def _frame(spark, rows):
    return spark.createDataFrame(rows, model.RAW_SCHEMA)


@pytest.mark.parametrize("sensor_type,ok,alert,rejected", THRESHOLD_CASES)
def test_thresholds(spark, sensor_type, ok, alert, rejected):
    rows = []
    for i, v in enumerate(ok + alert + rejected):
        rows.append(reading(sensor_id=f"id-{i}", type=sensor_type, value=v))
    out = {r.sensor_id: r.is_alert for r in to_warehouse(_frame(spark, rows)).collect()}
    for i, v in enumerate(ok):
        assert out[f"id-{i}"] is False, v
    for j, v in enumerate(alert):
        assert out[f"id-{len(ok) + j}"] is True, v
    for k, v in enumerate(rejected):
        assert f"id-{len(ok) + len(alert) + k}" not in out, v


def test_alert_flag_unknown_type_is_false(spark):
    df = spark.createDataFrame([("humidity", 1000.0)], "type string, value double")
    assert df.select(alert_flag().alias("a")).first().a is False


def test_normalise_trims_and_lowers(spark):
    df = _frame(spark, [reading(type=" Temperature ", site=" Site_Lyon ", sensor_id=" x ")])
    row = normalise(df).first()
    assert (row.type, row.site, row.sensor_id) == ("temperature", "Site_Lyon", "x")
    assert validate(normalise(df)).count() == 1


def test_reject_reasons(spark):
    rows = [
        reading(sensor_id="blank-site", site="  "),
        reading(sensor_id="nan", value=math.nan),
        reading(sensor_id="neg", value=-1.0),
        reading(sensor_id="other", type="humidity"),
        reading(sensor_id="late", timestamp="14:30:45"),
        {"sensor_id": "sparse", "type": "pressure", "value": None, "unit": None, "site": None, "machine": None, "timestamp": None},
        reading(sensor_id="good"),
    ]
    tagged = with_reject_reasons(normalise(_frame(spark, rows)))
    reasons = {r.sensor_id: r.reject_reasons for r in tagged.collect()}
    assert reasons["blank-site"] == ["site_missing"]
    assert reasons["nan"] == ["nan_value"]
    assert reasons["neg"] == ["negative_value"]
    assert reasons["other"] == ["unknown_type"]
    assert reasons["late"] == ["timestamp_unreadable"]
    assert reasons["sparse"] == ["value_missing", "site_missing", "machine_missing", "timestamp_missing"]
    assert reasons["good"] == []
    # an unreadable time is found when the time is parsed
    assert [r.sensor_id for r in validate(normalise(_frame(spark, rows))).collect()] == ["late", "good"]
    assert [r.sensor_id for r in to_warehouse(_frame(spark, rows)).collect()] == ["good"]


def test_warehouse_row_shape(spark):
    out = to_warehouse(_frame(spark, [reading()]))
    assert tuple(out.columns) == model.WAREHOUSE_COLUMNS
    row = out.first()
    assert (row.year, row.month, row.day, row.hour) == (2026, 1, 8, 6)
    assert row.ingestion_timestamp is not None


def test_no_python_udf_in_transform_plan(spark):
    plan = to_warehouse(_frame(spark, [reading()]))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_infinite_values_are_rejected(spark):
    rows = [reading(sensor_id="inf", value=float("inf")), reading(sensor_id="low", value=float("-inf")), reading(sensor_id="big", value=1e300)]
    reasons = {r.sensor_id: r.reject_reasons for r in with_reject_reasons(normalise(_frame(spark, rows))).collect()}
    assert reasons == {"inf": ["infinite_value"], "low": ["infinite_value", "negative_value"], "big": []}
