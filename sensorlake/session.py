"""Session helpers: a local session for tests / bench, and shared scratch paths.

Library functions never create a session: they use the caller's.  Scratch
and checkpoint locations are always taken from the session's
``spark.checkpoint.dir`` (a shared folder on a cluster); a local default is
set only when the session has none, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "sensorlake", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings this library assumes (tests, bench)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory, which all executors must share.

    Taken from the context or from ``spark.checkpoint.dir``; a local default
    exists only where ``build_session`` or a local master set one up, as in tests."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        base = tempfile.mkdtemp(prefix="sensorlake-ckpt-")
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sensorlake/{name}-{uuid.uuid4().hex[:12]}"


#: State partitions that a stream has at least, if there are as many shuffle partitions, and those for each core.
LEAST_STATE_PARTITIONS, STATE_PARTITIONS_PER_CORE = 32, 2


@contextmanager
def bounded_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in a number of partitions that follows the cores, not the data.

    Every task on a state sends the driver a figure for each of the state's partitions, so what a batch sends grows with
    their square, and each partition is loaded and committed in every batch.  A stream takes its settings when it is
    started and keeps this number in its checkpoint: one that was begun with another goes on with that."""
    name, cores = "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism
    held = spark.conf.get(name)
    spark.conf.set(name, str(min(int(held), max(LEAST_STATE_PARTITIONS, STATE_PARTITIONS_PER_CORE * cores))))
    try:
        yield
    finally:
        spark.conf.set(name, held)


def observation(name: str):
    """An ``Observation`` with a session-unique name (names must not repeat)."""
    from pyspark.sql import Observation

    return Observation(f"{name}-{uuid.uuid4().hex[:12]}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` through Hadoop's FileSystem API (our own scratch only)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hpath):
        fs.delete(hpath, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file through Hadoop's FileSystem API."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(hpath, True).close()


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder; ``target`` must not exist."""
    jvm = spark.sparkContext._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(new) or not fs.rename(old, new):
        raise RuntimeError(f"could not move {source} to {target}")


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Puts the file ``source`` in the place of ``target`` in one step, where the file system has one: readers find the old or the new file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, old = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = new.getFileSystem(conf)
    fs.mkdirs(old.getParent())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(new).toUri(), conf).rename(fs.makeQualified(new), fs.makeQualified(old), over)


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The data files that a write left directly in a folder."""
    return [f"{path.rstrip('/')}/{n}" for n in list_names(spark, path) if n.startswith("part-")]
