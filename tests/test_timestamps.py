"""T1 + T2: timestamp text rules (FIXTURES §4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorlake.functions import parse_timestamp

CASES = [
    ("2026-01-08T14:30:45.123456", dt.datetime(2026, 1, 8, 14, 30, 45, 123000)),
    ("2026-01-08 14:30:45,5", dt.datetime(2026, 1, 8, 14, 30, 45, 500000)),
    ("2026-01-08T14:30:45", dt.datetime(2026, 1, 8, 14, 30, 45)),
    ("2026-01-08 14:30:45", dt.datetime(2026, 1, 8, 14, 30, 45)),
    ("2026-01-08T14:30:45Z", dt.datetime(2026, 1, 8, 14, 30, 45)),
    ("2026-01-08T14:30:45.123+02:00", dt.datetime(2026, 1, 8, 14, 30, 45, 123000)),
    ("2026-01-08T14:30:45-0500", dt.datetime(2026, 1, 8, 14, 30, 45)),
    # the reference converts this one; our rule keeps the wall clock
    ("2026-01-08T14:30:45+02", dt.datetime(2026, 1, 8, 14, 30, 45)),
    # whatever zone follows is ignored
    *[(f"2026-01-08T14:30:45{z}", dt.datetime(2026, 1, 8, 14, 30, 45)) for z in (
        "z", "+2", "+02:00:00", " PST", " Europe/Paris", "[Europe/Paris]", "+01:00[Europe/Paris]", " GMT+2", " +0200", " America/Argentina/Buenos_Aires")],
    ("2026-01-08T14:30+2", dt.datetime(2026, 1, 8, 14, 30)),
    # what follows is no zone
    ("2026-01-08T14:30:45 12!", None),
    ("2026-01-08 and more 7", None),
    *[(f"2026-01-08{t}", None) for t in (
        " 02:30 PM", " 02:30:00 am", "T10:00:00 sensor broken", " garbage", " PST", " Europe/Paris", "-05", " 10:00 and/or", "T10:00:00[PM]", "T10:00:00 zz", "T10:00:00ZPM",
        "T10:00:00 Europe", "T10:00:00 pst", "T10:00:00 ESTPST")],
    *[(f"2026-01-08{t}", dt.datetime(2026, 1, 8)) for t in ("Z", "z", "+02:00", "-0500")],
    *[(f"2026-01-08T10:00{z}", dt.datetime(2026, 1, 8, 10)) for z in (" Etc/GMT+3", "[UTC]", " UTC+01:00", " CEST", " NZDT")],
    ("2026-01-08", dt.datetime(2026, 1, 8)),
    ("2026-01-08T14:30", dt.datetime(2026, 1, 8, 14, 30)),
    ("  2026-01-08T14:30:45.5  ", dt.datetime(2026, 1, 8, 14, 30, 45, 500000)),
    ("2026-01-08T14:30:45.123456789Z", dt.datetime(2026, 1, 8, 14, 30, 45, 123000)),
    # rejected: no leading date, garbage, empty, out of range
    ("14:30:45", None),
    ("garbage", None),
    ("", None),
    ("2026-13-40T00:00:00", None),
    ("2026-02-30", None),
    (None, None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CASES)], "i int, s string")
    rows = df.select("i", parse_timestamp(F.col("s")).cast("timestamp_ntz").alias("t")).collect()
    return {r.i: r.t for r in rows}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_parse(parsed, i):
    assert parsed[i] == CASES[i][1], CASES[i][0]


def test_parse_is_null_not_error_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("not a time",)], "s string")
    assert df.select(parse_timestamp(F.col("s")).alias("t")).first().t is None


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from sensorlake.sources.events import TIME_TEXT_VARIANTS, time_text_variants  # noqa: E402


def _truncated(t, variant):
    fmt = TIME_TEXT_VARIANTS[variant][0]
    if fmt.endswith("HH:mm"):
        return t.replace(second=0, microsecond=0)
    if fmt.endswith("ss"):
        return t.replace(microsecond=0)
    return t.replace(microsecond=t.microsecond // 1000 * 1000)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2099, 12, 31)), min_size=1, max_size=80))
def test_every_text_variant_parses_to_the_wall_clock(spark, times):
    rows = [(i, t) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz")
    text = time_text_variants(F.col("t"), F.col("k"))
    got = df.select("k", parse_timestamp(text).cast("timestamp_ntz").alias("p")).collect()
    n = len(TIME_TEXT_VARIANTS)
    for r in got:
        assert r.p == _truncated(times[r.k], r.k % n), (times[r.k], r.k % n)
