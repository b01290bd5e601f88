"""Raw JSON readings: batch scan, directory discovery, stream source.

Files are read with the declared schema plus ``_corrupt_record``, in
PERMISSIVE mode, so a malformed file becomes a row with the text kept
(quarantined later) instead of an all-NULL row.  ``pathGlobFilter`` keeps
only ``*.json`` names in batch and stream alike.  ``multiLine`` is a
parameter: true reads one (pretty-printed) object or array per file, as the
sensors write them; false reads line-delimited JSON, which Spark can split
inside a file — prefer it for large landing files.

Directory checks use Hadoop's FileSystem API, so they work on HDFS / object
stores and not only on the driver's local disk.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake import model

JSON_GLOB = "*.json"
#: A hundred years.
ANY_AGE = "36500d"


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def has_matching_files(spark: SparkSession, directory: str, glob: str = JSON_GLOB) -> bool:
    """True if ``directory`` exists and holds at least one file whose name matches
    ``glob``; the listing stops at the first one."""
    fs, hpath = _fs_and_path(spark, directory)
    if not fs.exists(hpath):
        return False
    entries = fs.listStatusIterator(hpath)
    while entries.hasNext():
        status = entries.next()
        if status.isFile() and fnmatchcase(status.getPath().getName(), glob):
            return True
    return False


def sensor_dirs(spark: SparkSession, root: str, types: Iterable[str] = model.SENSOR_TYPES, glob: str = JSON_GLOB) -> list[str]:
    """The per-type directories under ``root`` that exist and hold JSON files."""
    dirs = [f"{root.rstrip('/')}/{t}" for t in types]
    return [d for d in dirs if has_matching_files(spark, d, glob)]


def _reader(spark: SparkSession, schema: T.StructType | None, multi_line: bool, glob: str | None):
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    reader = (
        reader.option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", model.CORRUPT_COLUMN)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the file each row came from and its modification time (for
    quarantine and replay)."""
    return df.withColumns(
        {
            model.SOURCE_FILE_COLUMN: F.col("_metadata.file_path"),
            model.SOURCE_MODIFIED_COLUMN: F.col("_metadata.file_modification_time"),
        }
    )


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = model.RAW_READ_SCHEMA,
    glob: str | None = JSON_GLOB,
    source_file: bool = True,
    *,
    multi_line: bool,
) -> DataFrame:
    """One scan over every path, declared schema + corrupt-record column."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = _reader(spark, schema, multi_line, glob).json(paths)
    return with_source_file(df) if source_file else df


def read_sensor_dirs(
    spark: SparkSession,
    root: str,
    types: Iterable[str] = model.SENSOR_TYPES,
    glob: str = JSON_GLOB,
    *,
    multi_line: bool,
) -> DataFrame | None:
    """S1 + S2: all populated type directories in one scan; None if there are none."""
    dirs = sensor_dirs(spark, root, types, glob)
    if not dirs:
        return None
    return read_json(spark, dirs, multi_line=multi_line, glob=glob)


def infer_schema(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True, glob: str | None = JSON_GLOB) -> T.StructType:
    """The schema Spark infers from the files (input of the drift check)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return _reader(spark, None, multi_line, glob).json(paths).schema


def stream_options(reader, max_files_per_trigger: int | None, glob: str, max_bytes_per_trigger: str | None = None, max_file_age: str = ANY_AGE, archive: str | None = None):
    """Options of a file source: how much a trigger admits, which names, files of what age, and where read files go."""
    reader = reader.option("pathGlobFilter", glob).option("maxFileAge", max_file_age)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    elif max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader


def stream_json(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    glob: str = JSON_GLOB,
    schema: T.StructType = model.RAW_READ_SCHEMA,
    source_file: bool = True,
    *,
    multi_line: bool,
    **options,
) -> DataFrame:
    """Structured Streaming file source over ``path``.

    ``path`` may be a Hadoop glob, e.g. ``root/{temperature,vibration,pressure}``,
    so all sensor types are one source (one file listing, one offset log).
    ``max_file_age``: Spark leaves out files that are older than the newest by
    more than this; the default leaves out none.  ``archive``: read files are
    moved there, which keeps the listing short in the long run.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", model.CORRUPT_COLUMN)
    )
    df = stream_options(reader, max_files_per_trigger, glob, **options).json(path)
    return with_source_file(df) if source_file else df


def sensor_glob(root: str, types: Iterable[str] = model.SENSOR_TYPES) -> str:
    return f"{root.rstrip('/')}/{{{','.join(types)}}}"
