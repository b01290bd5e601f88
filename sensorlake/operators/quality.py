"""Data-quality diagnostics (Q1-Q7), as Spark jobs over all rows / files.

The reference checks one file per type on the driver and prints; here each
check is a DataFrame over the whole input, so it scales with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake import model
from sensorlake.operators.cleaning import valid_condition, with_reject_reasons


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q1: NULL count of every column, one pass: (column_name, null_count)."""
    meta = (model.SOURCE_FILE_COLUMN, model.SOURCE_MODIFIED_COLUMN)
    cols = list(columns) if columns else [c for c in df.columns if c not in meta]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "null_count")


def corrupt_records(df: DataFrame) -> DataFrame:
    """Q2: rows the JSON reader could not parse, with their text and file."""
    cols = [model.CORRUPT_COLUMN] + ([model.SOURCE_FILE_COLUMN] if model.SOURCE_FILE_COLUMN in df.columns else [])
    # Selecting a regular column too: a scan may not read only the corrupt column.
    return df.filter(F.col(model.CORRUPT_COLUMN).isNotNull()).select("sensor_id", *cols)


def valid_by_type(df: DataFrame) -> DataFrame:
    """Q3: per raw type: rows, rows with an id, valid rows."""
    return df.groupBy("type").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("sensor_id").alias("with_sensor_id"),
        F.count_if(valid_condition(df)).alias("valid"),
    )


def bom_check(spark: SparkSession, paths: str | Sequence[str], glob: str = "*.json") -> DataFrame:
    """Q4: every file: size, UTF-8 byte-order-mark flag, first 50 characters.

    ``binaryFile`` loads each file whole into one row (Spark's line reader would
    drop the mark): meant for landing files of readings, which are small.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)
    return files.select(
        F.col("path"),
        F.col("length"),
        (F.hex(F.substring("content", 1, 3)) == F.lit("EFBBBF")).alias("has_bom"),
        F.substring(F.col("content").cast("string"), 1, 50).alias("head"),
    )


def _flat_types(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def _is_drift(declared: str, inferred: str) -> bool:
    """Whole numbers fit a double column, and a column without any value has no type."""
    return declared != inferred and (declared, inferred) != ("double", "bigint") and inferred != "void"


def schema_drift(spark: SparkSession, declared: T.StructType, inferred: dict[str, T.StructType]) -> DataFrame:
    """Q5: per sensor type, columns missing from the data, extra in the data, or typed differently.

    ``inferred``: schema by type.  All inputs are schemas (metadata, a few fields), compared on the driver.
    """
    rows = []
    d = _flat_types(declared)
    for sensor_type, schema in inferred.items():
        i = _flat_types(schema)
        for name, t in d.items():
            if name == model.CORRUPT_COLUMN:
                continue
            if name not in i:
                rows.append((sensor_type, name, "missing", t, None))
            elif _is_drift(t, i[name]):
                rows.append((sensor_type, name, "type_differs", t, i[name]))
        for name, t in i.items():
            if name not in d and name != model.CORRUPT_COLUMN:
                rows.append((sensor_type, name, "extra", None, t))
    columns = "sensor_type string, column_name string, issue string, declared_type string, inferred_type string"
    return spark.createDataFrame(rows, columns)


#: What a variant's kind may be for a declared type, by its first word; nothing (VOID) fits all of them.
_FITTING = {"string": ("STRING",), "double": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")}


def field_drift(texts: DataFrame, declared: T.StructType = model.RAW_SCHEMA) -> DataFrame:
    """Q5 at the grain of files: per ``sensor_type`` and ``day``, the fields of JSON objects that are missing, extra or of
    another type than declared, with the number of readings and the first file that has it.

    ``texts``: one row per reading, with ``text``, ``sensor_type``, ``day`` and ``file``.  Every text is parsed once, as
    VARIANT, and its fields are counted by name and kind in one aggregate; a text that is no object counts as
    ``unreadable``.  A field that is null is neither missing nor of another type."""
    said = F.try_parse_json("text")
    names = [f.name for f in declared.fields]
    entry = lambda name, kind: F.struct(F.lit(name).alias("name") if isinstance(name, str) else name.alias("name"), kind.alias("kind"))
    absent = [F.when(F.try_variant_get("v", f"$.{n}", "variant").isNull(), entry(n, F.lit("ABSENT"))) for n in names]
    parsed = texts.select("sensor_type", "day", "file", said.alias("v")).withColumn("is_object", F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    parsed = parsed.withColumn("absent", F.when(F.col("is_object"), F.array_compact(F.array(*absent))).otherwise(F.array(entry("", F.lit("UNREADABLE")))))
    fields = texts.sparkSession.tvf.variant_explode_outer(F.when(F.col("is_object"), F.col("v")).outer())
    each = parsed.lateralJoin(fields.select("pos", "key", F.schema_of_variant("value").alias("kind")))
    own = F.when(F.col("key").isNotNull(), F.array(entry(F.col("key"), F.col("kind"))))
    # What a text lacks goes with its first field, or with the one row of a text without fields.
    with_first = F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("absent"))
    none = F.array().cast("array<struct<name:string,kind:string>>")
    told = each.select("sensor_type", "day", "file", F.explode(F.concat(F.coalesce(own, none), F.coalesce(with_first, none))).alias("f"))
    counted = told.groupBy("sensor_type", "day", "f.name", "f.kind").agg(F.count(F.lit(1)).alias("readings"), F.min("file").alias("first_file"))
    kind_of = F.regexp_extract("kind", "^[A-Z]+", 0)
    fits = F.col("kind") == "VOID"
    for f in declared.fields:
        kinds = _FITTING.get(f.dataType.simpleString(), (f.dataType.simpleString().upper(),))
        fits = fits | ((F.col("name") == f.name) & kind_of.isin(*kinds))
    types = F.create_map(*[F.lit(x) for f in declared.fields for x in (f.name, f.dataType.simpleString())])
    issue = (
        F.when(F.col("kind") == "UNREADABLE", "unreadable")
        .when(F.col("kind") == "ABSENT", "missing")
        .when(~F.col("name").isin(*names), "extra")
        .otherwise("type_differs")
    )
    return counted.filter(~fits).select(
        "sensor_type", "day", F.col("name").alias("column_name"), issue.alias("issue"), F.try_element_at(types, "name").alias("declared_type"),
        F.when(~F.col("kind").isin("ABSENT", "UNREADABLE"), F.col("kind")).alias("found_type"), "readings", "first_file",
    )


def reading_texts(spark: SparkSession, paths: Sequence[str], glob: str = "*.json") -> DataFrame:
    """The lines of line-delimited files as ``field_drift`` takes them: the type is the files' folder, the day that of their
    modification."""
    lines = spark.read.text(list(paths), pathGlobFilter=glob).filter(F.trim("value") != "")
    return lines.select(
        F.col("value").alias("text"),
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("sensor_type"),
        F.to_date(F.col("_metadata.file_modification_time")).alias("day"),
        F.col("_metadata.file_path").alias("file"),
    )


def reject_reason_counts(df: DataFrame) -> DataFrame:
    """Q6: rejected rows per reason (a row with several reasons counts in each)."""
    tagged = df if "reject_reasons" in df.columns else with_reject_reasons(df)
    return (
        tagged.select(F.explode("reject_reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Q7: a few rows to look at (batch DataFrames; in a stream, per micro-batch)."""
    return df.limit(n)
