"""CSV report files (K3-K6).

Aggregated reports are small: ``coalesce(1)`` gives one ordered file.  Raw
extracts stay multi-part (one writer per partition) unless a single file is
explicitly asked for.  Renames use Hadoop's FileSystem API (no local
``shutil``), so they work on any cluster file system.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from sensorlake.session import part_files, remove_path, replace_file


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    """K3: a CSV directory with a header row; one file only where the rows are few by nature."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)
    return path


def export_single_csv(df: DataFrame, directory: str, name: str) -> str:
    """K4: ``<directory>/<name>.csv`` as one file (header-only when empty), put in the place of the old one in one step."""
    spark = df.sparkSession
    folder = directory.rstrip("/")
    aside = f"{folder}/_{name}_tmp_{uuid.uuid4().hex[:8]}"
    write_csv(df, aside, single_file=True)
    parts = part_files(spark, aside)
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {aside}, found {len(parts)}")
    target = f"{folder}/{name}.csv"
    replace_file(spark, parts[0], target)
    remove_path(spark, aside)
    return target
