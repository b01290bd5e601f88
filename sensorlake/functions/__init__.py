"""Column-expression builders (pure ``Column -> Column``, all JVM-side)."""

from sensorlake.functions.alerts import alert_flag, status_label
from sensorlake.functions.rounding import avg_half_up, pct_half_up, round_half_up
from sensorlake.functions.timestamps import clean_timestamp_text, parse_timestamp

__all__ = [
    "alert_flag",
    "status_label",
    "avg_half_up",
    "pct_half_up",
    "round_half_up",
    "clean_timestamp_text",
    "parse_timestamp",
]
