"""Schemas, thresholds and constants shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# ---------------------------------------------------------------------------
SENSOR_TYPES = ("temperature", "vibration", "pressure")

# type -> (min, max); an alert is strictly outside [min, max].
ALERT_THRESHOLDS = {
    "temperature": (0.0, 85.0),
    "vibration": (0.0, 7.0),
    "pressure": (0.5, 6.0),
}

UNITS = {"temperature": "Celsius", "vibration": "mm/s", "pressure": "bar"}

# Live-monitor status labels.
STATUS_ALERT = "\U0001F6A8"  # police-car light
STATUS_OK = "✅"  # white heavy check mark

# Warehouse partition columns, in order.
PARTITION_COLUMNS = ("site", "type", "year", "month", "day")

# Columns that must be present (non-null, non-blank) for a reading to be valid.
REQUIRED_COLUMNS = ("sensor_id", "type", "value", "site", "machine", "timestamp")

RAW_FIELDS = (
    ("sensor_id", T.StringType()),
    ("type", T.StringType()),
    ("value", T.DoubleType()),
    ("unit", T.StringType()),
    ("site", T.StringType()),
    ("machine", T.StringType()),
    ("timestamp", T.StringType()),
)

# ---------------------------------------------------------------------------
# Our own constants (not the reference's).
# ---------------------------------------------------------------------------
CORRUPT_COLUMN = "_corrupt_record"
SOURCE_FILE_COLUMN = "source_file"
SOURCE_MODIFIED_COLUMN = "source_modified"
#: Values before a row in its file, where files are read value by value.
SOURCE_PLACE_COLUMN = "source_place"

RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])

# Read schema for JSON files: the raw fields plus the corrupt-record column,
# so malformed files are kept (and quarantined) instead of silently nulled.
RAW_READ_SCHEMA = T.StructType(
    list(RAW_SCHEMA.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

WAREHOUSE_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("unit", T.StringType(), True),
        T.StructField("site", T.StringType(), True),
        T.StructField("machine", T.StringType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
        T.StructField("day", T.IntegerType(), True),
        T.StructField("hour", T.IntegerType(), True),
        T.StructField("is_alert", T.BooleanType(), True),
        T.StructField("ingestion_timestamp", T.TimestampType(), True),
    ]
)

WAREHOUSE_COLUMNS = tuple(f.name for f in WAREHOUSE_SCHEMA.fields)
