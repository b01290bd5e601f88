"""Adapter: the test ``events`` table as raw sensor readings.

The test data has no sensor table; ``events`` stands in for it.  The
mapping (also written in SQL in ``__spark_entry__.oracle_sql``):

* ``sensor_id`` = event_id as text (unique per reading, like the UUID)
* ``type``: click -> temperature, view -> vibration, purchase -> pressure;
  other event types pass through unchanged and are rejected by validation
* ``value``: as is for temperature, divided by 10 for vibration / pressure
* ``unit`` by type; ``site`` = 'Site_' || user_id % 5;
  ``machine`` = 'Machine_' || (user_id div 5) % 5 (same names on every site)
* ``timestamp``: ISO-8601 text with microseconds, as sensors send it
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import model

EVENT_TYPE_TO_SENSOR = {"click": "temperature", "view": "vibration", "purchase": "pressure"}
SCALED_TYPES = ("vibration", "pressure")
SITE_COUNT = 5
MACHINES_PER_SITE = 5
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mapped(c: Column, mapping: dict[str, str], default: Column | None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(default) if default is not None else expr


def readings_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> raw reading rows (``model.RAW_SCHEMA``)."""
    sensor_type = _mapped(F.col("event_type"), EVENT_TYPE_TO_SENSOR, F.col("event_type"))
    scaled = F.col("event_type").isin(*[k for k, v in EVENT_TYPE_TO_SENSOR.items() if v in SCALED_TYPES])
    unit = _mapped(F.col("event_type"), {k: model.UNITS[v] for k, v in EVENT_TYPE_TO_SENSOR.items()}, None)
    return events.select(
        F.col("event_id").cast("string").alias("sensor_id"),
        sensor_type.alias("type"),
        F.when(scaled, F.col("value") / F.lit(10)).otherwise(F.col("value")).alias("value"),
        unit.alias("unit"),
        F.concat(F.lit("Site_"), (F.col("user_id") % SITE_COUNT).cast("string")).alias("site"),
        F.concat(
            F.lit("Machine_"),
            (F.expr(f"user_id div {SITE_COUNT}") % MACHINES_PER_SITE).cast("string"),
        ).alias("machine"),
        F.date_format(F.col("ts"), ISO_MICROS).alias("timestamp"),
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(read_table(spark, sf_dir, "events"))


def warehouse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings from ``events`` through the full ingest transform."""
    from sensorlake.operators.derive import to_warehouse

    return to_warehouse(raw_readings(spark, sf_dir))


def landing_dir_column() -> Column:
    """Directory a reading lands in: its own type, or (for a type that is
    not a sensor type) one of the sensor directories picked by its id, as a
    mis-routed reading would arrive."""
    types = [F.lit(t) for t in model.SENSOR_TYPES]
    routed = F.element_at(F.array(*types), (F.pmod(F.xxhash64("sensor_id"), F.lit(len(types))) + 1).cast("int"))
    return F.when(F.col("type").isin(*types), F.col("type")).otherwise(routed)


#: Line-delimited files that one landing writes for a sensor type, and the readings from which on it writes a further one.
LINE_FILES, READINGS_PER_FILE = 2, 500_000


def _to_files(part: DataFrame, count: int) -> DataFrame:
    """``part`` in as many partitions as files are to be written for its ``count`` rows, of about the same size each."""
    return part.repartition(max(1, min(LINE_FILES, -(-count // READINGS_PER_FILE))))


def land_readings(readings: DataFrame, root: str, value_as_text: Column | None = None) -> str:
    """Write raw readings as line-delimited JSON files under ``root/<type>/``.

    Line-delimited files are split inside by their readers, so with more readings the files grow, not their number: a
    stream that takes one file a batch compares each batch with the table, which batches in proportion to the readings
    would make quadratic.

    ``value_as_text``: rows for which it holds carry ``value`` as a JSON
    string (a type error the JSON reader sends to ``_corrupt_record``).
    Returns ``root``.  Read back with ``multi_line=False``.
    """
    as_text = F.lit(False) if value_as_text is None else F.coalesce(value_as_text, F.lit(False))
    routed = readings.withColumns({"_dir": landing_dir_column(), "_text": as_text})
    counts = {(r["_dir"], r["_text"]): r["count"] for r in routed.groupBy("_dir", "_text").count().collect()}  # two rows a sensor type

    def land(t: str) -> None:
        for text in (False,) if value_as_text is None else (False, True):
            part = routed.filter((F.col("_dir") == F.lit(t)) & (F.col("_text") == F.lit(text))).drop("_dir", "_text")
            if text:
                part = part.withColumn("value", F.col("value").cast("string"))
            _to_files(part, counts.get((t, text), 0)).write.mode("append").option("ignoreNullFields", False).json(f"{root}/{t}")

    with ThreadPoolExecutor(len(model.SENSOR_TYPES)) as pool:  # few files each: the types' jobs run beside each other
        list(pool.map(land, model.SENSOR_TYPES))
    return root


def _in_files(readings: DataFrame, per_file: int, most: int) -> DataFrame:
    """``readings`` with their directory ``_dir`` and a number ``_file``, about ``per_file`` of them with one number, or
    more where that would take more than ``most`` files a directory."""
    routed = readings.withColumn("_dir", landing_dir_column())
    files = F.lit(1)
    for r in routed.groupBy("_dir").count().collect():  # one row a sensor type
        files = F.when(F.col("_dir") == r["_dir"], F.lit(min(most, -(-r["count"] // per_file)))).otherwise(files)
    return routed.withColumn("_file", F.pmod(F.xxhash64("sensor_id"), files))


def land_texts(texts: DataFrame, root: str) -> str:
    """One file for each row (``_dir``, ``value``) under ``root/<type>/``, of Spark's own names (``part-*``)."""
    for t in model.SENSOR_TYPES:
        texts.filter(F.col("_dir") == t).select("value").write.option("maxRecordsPerFile", 1).mode("append").text(f"{root}/{t}")
    return root


#: Files of many values that one landing writes for a sensor type at most; from there on the files grow.  A batch reads
#: thousands of files, a stream takes some a trigger and compares them with the table.
BATCH_FILES, STREAM_FILES = 1_000, 32


def land_arrays(readings: DataFrame, root: str, per_file: int = 500, most: int = BATCH_FILES) -> str:
    """Write raw readings as files of one pretty-printed JSON array of about
    ``per_file`` readings each, more where there would be more than ``most`` files of a type, under ``root/<type>/``;
    read back with ``multi_line=True`` and ``glob="part-*"``."""
    names = [c for c, _ in model.RAW_FIELDS]
    array = F.to_json(F.collect_list(F.struct(*names)), {"pretty": "true", "ignoreNullFields": "false"})
    return land_texts(_in_files(readings, per_file, most).groupBy("_dir", "_file").agg(array.alias("value")), root)


#: What is wrong with a reading's text in `land_damaged`, by its id modulo 10: cut off before its last brace, no value, junk before it.
CUT_OFF, NO_VALUE, JUNK = 3, 7, 9


def land_damaged(readings: DataFrame, root: str, per_file: int = 50, most: int = BATCH_FILES) -> str:
    """Raw readings as files in four layouts (array, one object behind the other, line by line, array behind a byte-order
    mark), two readings of ten damaged and one with a stray word before it; read back like ``land_arrays``."""
    names = [c for c, _ in model.RAW_FIELDS]
    kind = F.col("sensor_id").cast("long") % 10
    said = _in_files(readings, per_file, most).withColumn("said", F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))
    damaged = (
        F.when(kind == CUT_OFF, F.expr("substring(said, 1, length(said) - 1)"))
        .when(kind == NO_VALUE, F.regexp_replace("said", '"value":[^,]*,', '"value":,'))
        .when(kind == JUNK, F.concat(F.lit("junk"), F.col("sensor_id"), F.lit(" "), F.col("said")))
        .otherwise(F.col("said"))
    )
    texts = said.withColumn("said", damaged).groupBy("_dir", "_file").agg(F.sort_array(F.collect_list("said")).alias("all"))
    layout = F.pmod(F.col("_file"), F.lit(4))
    array = F.concat(F.lit("["), F.array_join("all", ",\n"), F.lit("]"))
    value = (
        F.when(layout == 0, array).when(layout == 1, F.array_join("all", " ")).when(layout == 2, F.array_join("all", "\n"))
        .otherwise(F.concat(F.lit("\ufeff"), array))
    )
    return land_texts(texts.select("_dir", value.alias("value")), root)


# Sensor time text in the forms found in the field (separator, fraction,
# zone suffix, precision), chosen per reading by its id.  Every form keeps
# the wall clock; the zone suffixes are removed by the parser.
TIME_TEXT_VARIANTS = (
    (ISO_MICROS, "", ""),
    ("yyyy-MM-dd HH:mm:ss,SSS", "", ""),
    ("yyyy-MM-dd'T'HH:mm:ss", "", ""),
    ("yyyy-MM-dd HH:mm:ss", "Z", ""),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS", "+02:00", "  "),
    ("yyyy-MM-dd'T'HH:mm:ss", "-0500", ""),
    (ISO_MICROS, "+02", ""),
    ("yyyy-MM-dd'T'HH:mm", "", " "),
    (ISO_MICROS, " Europe/Paris", ""),
    ("yyyy-MM-dd HH:mm:ss,SSS", "z", ""),
    ("yyyy-MM-dd'T'HH:mm:ss.SSS", "+2", ""),
    ("yyyy-MM-dd'T'HH:mm:ss", "+02:00:00", ""),
    (ISO_MICROS, " PST", ""),
)


def time_text_variants(ts: Column, key: Column) -> Column:
    """``ts`` rendered as text in the variant ``key % len(TIME_TEXT_VARIANTS)``."""
    k = F.pmod(key, F.lit(len(TIME_TEXT_VARIANTS)))
    expr = None
    for i, (fmt, suffix, pad) in enumerate(TIME_TEXT_VARIANTS):
        text = F.concat(F.lit(pad), F.date_format(ts, fmt), F.lit(suffix), F.lit(pad))
        expr = F.when(k == F.lit(i), text) if expr is None else expr.when(k == F.lit(i), text)
    return expr
