"""Published counts (FIXTURES §6) and a property test of the validation rules."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sensorlake import model
from sensorlake.operators import reports
from sensorlake.operators.derive import to_warehouse
from sensorlake.sources.events import warehouse_rows

# (type -> (readings, alerts)) after adapter + validation, from FIXTURES.md
EXPECTED = {
    "/root/testdata/sf0.01": {"temperature": (2006, 381), "vibration": (1982, 479), "pressure": (1981, 761)},
    "/root/testdata/sf0.1": {"temperature": (19863, 3625), "vibration": (19941, 4952), "pressure": (20084, 7853)},
}


@pytest.mark.parametrize("sf_dir", sorted(EXPECTED))
def test_alert_counts_match_fixtures(spark, sf_dir):
    got = {
        r.type_capteur: (r.total_mesures, r.alertes_critiques)
        for r in reports.alerts_by_type_pct(warehouse_rows(spark, sf_dir)).collect()
    }
    assert got == EXPECTED[sf_dir]


def _python_rule(r):
    """The validation and alert rules, written plainly for comparison."""
    t = r["type"].strip().lower() if r["type"] is not None else None
    keys = [r["sensor_id"], r["site"], r["machine"]]
    if any(k is None or k.strip() == "" for k in keys) or t not in model.SENSOR_TYPES:
        return None
    v = r["value"]
    if v is None or math.isnan(v) or v < 0:
        return None
    lo, hi = model.ALERT_THRESHOLDS[t]
    return v < lo or v > hi


values = st.one_of(
    st.none(),
    st.just(math.nan),
    st.floats(min_value=-5, max_value=130, allow_nan=False),
    st.sampled_from([0.0, 0.49, 0.5, 6.0, 6.01, 7.0, 7.001, 85.0, 85.01]),
)
rows = st.lists(
    st.fixed_dictionaries(
        {
            "type": st.sampled_from(["temperature", " Vibration ", "PRESSURE", "humidity", "", None]),
            "value": values,
            "site": st.sampled_from(["Site_Paris", " ", None]),
            "machine": st.sampled_from(["Machine_A1", None]),
        }
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_validation_and_alerts_match_plain_rules(spark, generated):
    data = []
    for i, r in enumerate(generated):
        data.append((f"id-{i}", r["type"], r["value"], "u", r["site"], r["machine"], "2026-01-08T10:00:00"))
    df = spark.createDataFrame(data, model.RAW_SCHEMA)
    got = {row.sensor_id: row.is_alert for row in to_warehouse(df).collect()}
    want = {}
    for i, r in enumerate(generated):
        flag = _python_rule({"sensor_id": f"id-{i}", **r})
        if flag is not None:
            want[f"id-{i}"] = flag
    assert got == want
