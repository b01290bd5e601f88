r"""Whole JSON files, value by value.

The multi-line reader of JSON takes the first value of a file, says nothing of
what follows and gives up a whole array for one bad element.  Here a file's
text is cut into its objects by one regular expression, which knows strings and
braces inside braces, and every object is parsed by itself: objects in an
array, one behind the other or line by line are all read, and one that is
damaged costs no other.  What stands between objects and is no bracket, comma,
white space or byte-order mark is kept as a corrupt record, with its place, the
number of values before it.  Files may be UTF-8 or UTF-16, with or without a
mark, as for Spark's reader.

A file is one row until it is cut, as in that reader; files of many readings
that are worth splitting between tasks should be line-delimited.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import model
from sensorlake.sources.json_files import JSON_GLOB, stream_options, with_source_file

#: Objects inside objects that a reading may have; an object that holds more is cut into those inside it.
DEPTH = 16

_INSIDE = r"""[^{}"']++|"(?:[^"\\\r\n]++|\\.)*+"|'(?:[^'\\\r\n]++|\\.)*+'"""


def _object(depth: int) -> str:
    inner = f"|{_object(depth - 1)}" if depth > 1 else ""
    return rf"\{{(?:{_INSIDE}{inner})*+\}}"


OBJECT = _object(DEPTH)
_MARK = "\ufeff"
_EDGES = rf"^[\s,\[\]{_MARK}]+|[\s,\[\]]+$"


def file_text(value: Column) -> Column:
    """The text of a file that was read as it is: UTF-16 where its first bytes say so, else UTF-8."""
    data = value.cast("binary")
    start = F.hex(F.substring(data, 1, 2))
    little = (start == "FFFE") | (F.substring(start, 3, 2) == "00")
    big = (start == "FEFF") | (F.substring(start, 1, 2) == "00")
    return F.when(little, F.decode(data, "UTF-16LE")).when(big, F.decode(data, "UTF-16BE")).otherwise(value)


def split_values(files: DataFrame) -> DataFrame:
    """One row per value of the files' texts (column ``value``), with the raw fields, the corrupt record, the columns of
    the source file that ``files`` has, and the value's place.  Works on batch and streaming frames."""
    text = file_text(F.col("value"))
    meta = [c for c in (model.SOURCE_FILE_COLUMN, model.SOURCE_MODIFIED_COLUMN) if c in files.columns]
    objects = F.regexp_extract_all("text", F.lit(OBJECT), F.lit(0))
    between = F.transform(F.split("text", OBJECT, -1), lambda gap: F.regexp_replace(gap, _EDGES, ""))
    rest = F.transform(between, lambda gap, i: F.struct(i.alias("place"), F.lit(None).cast("string").alias("object"), gap.alias("rest")))
    said = F.transform(objects, lambda o, i: F.struct(i.alias("place"), o.alias("object"), F.lit(None).cast("string").alias("rest")))
    all_values = F.concat(said, F.filter(rest, lambda r: r["rest"] != ""))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": model.CORRUPT_COLUMN}
    one = files.select(*meta, text.alias("text")).select(*meta, F.explode(all_values).alias("v"))
    parsed = one.select(*meta, "v", F.from_json("v.object", model.RAW_READ_SCHEMA, options).alias("p"))
    return parsed.select(
        *(F.col(f"p.{c}").alias(c) for c, _ in model.RAW_FIELDS),
        F.coalesce("v.rest", f"p.{model.CORRUPT_COLUMN}").alias(model.CORRUPT_COLUMN),
        *meta,
        F.col("v.place").cast("long").alias(model.SOURCE_PLACE_COLUMN),
    )


def read_values(spark: SparkSession, paths: str | Sequence[str], glob: str | None = JSON_GLOB) -> DataFrame:
    """Every value of every file, in one scan."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return split_values(with_source_file(spark.read.text(paths, wholetext=True, pathGlobFilter=glob)))


def stream_values(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, glob: str = JSON_GLOB, **options) -> DataFrame:
    """S3: the same as a stream; see ``json_files.stream_json`` for the options."""
    reader = stream_options(spark.readStream, max_files_per_trigger, glob, **options)
    return split_values(with_source_file(reader.text(path, wholetext=True)))


def recover_types(raw: DataFrame) -> DataFrame:
    """Corrupt records that are objects whose ``value`` is a number sent as text become readings.

    The kept text is parsed as VARIANT and its fields are taken one by one.  A value that is no number (an object, a
    word, a truth value), or a text that is no object, stays corrupt."""
    said = F.try_parse_json(model.CORRUPT_COLUMN)
    kind = F.schema_of_variant(F.try_variant_get(said, "$.value", "variant"))
    number = F.try_variant_get(said, "$.value", "double")
    fits = F.startswith(F.schema_of_variant(said), F.lit("OBJECT")) & (kind == "STRING") & number.isNotNull()
    parsed = raw.withColumn("_fits", F.coalesce(F.col(model.CORRUPT_COLUMN).isNotNull() & fits, F.lit(False)))
    fields = {
        c: F.when(F.col("_fits"), F.try_variant_get(said, f"$.{c}", t.simpleString())).otherwise(F.col(c)).alias(c)
        for c, t in model.RAW_FIELDS
    }
    kept = F.when(~F.col("_fits"), F.col(model.CORRUPT_COLUMN)).alias(model.CORRUPT_COLUMN)
    return parsed.select(*(fields.get(c, kept if c == model.CORRUPT_COLUMN else F.col(c)) for c in raw.columns))
