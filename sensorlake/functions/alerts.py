"""Alert flag (T4) and status label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorlake import model


def alert_flag(
    type_col: Column | str = "type",
    value_col: Column | str = "value",
    thresholds: Mapping[str, tuple[float, float]] = model.ALERT_THRESHOLDS,
) -> Column:
    """True when the value is strictly outside its type's [min, max]; else False.

    Compiled to one native CASE WHEN chain; unknown types are never alerts.
    """
    t = F.col(type_col) if isinstance(type_col, str) else type_col
    v = F.col(value_col) if isinstance(value_col, str) else value_col
    expr = None
    for sensor_type, (lo, hi) in thresholds.items():
        cond = (t == F.lit(sensor_type)) & ((v < F.lit(lo)) | (v > F.lit(hi)))
        expr = F.when(cond, F.lit(True)) if expr is None else expr.when(cond, F.lit(True))
    return F.lit(False) if expr is None else expr.otherwise(F.lit(False))


def status_label(is_alert: Column | str = "is_alert") -> Column:
    c = F.col(is_alert) if isinstance(is_alert, str) else is_alert
    return F.when(c, F.lit(model.STATUS_ALERT)).otherwise(F.lit(model.STATUS_OK))
