"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles a generated method above this size; smaller pieces run much faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
}

# For joins of wide rows with narrow tables: the side with small partitions is hashed, so the other one is not sorted.
HASH_JOINS = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m"}

# Rows of a shuffle partition, about, before small ones are put together.
ROWS_PER_PARTITION = 400_000
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Output files that a task writes at once; the writer sorts the rows that are left where there are more.
OPEN_FILES = 8


def build_session(app: str = "tidemark", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the library is written for; ``conf`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession, more: Mapping[str, str] = MappingProxyType({})) -> SparkSession:
    """Give an existing session the defaults, and ``more`` in place of some."""
    for key, value in {**DEFAULTS, **more}.items():
        spark.conf.set(key, value)
    return spark


def deal_out(spark: SparkSession, rows: int) -> None:
    """Let shuffles of ``rows`` rows have as many partitions as keep those of a task few, however large the input is.

    The session's number stays the least; adaptive execution puts small partitions together again. 0 takes the setting back.
    """
    parts = rows // ROWS_PER_PARTITION
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(parts))
    else:
        spark.conf.unset(INITIAL_PARTITIONS)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, object]) -> Iterator[None]:
    """Session settings for the plans that are run inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they need not have it installed."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="tidemark-code-")
        name = os.path.join(folder, "tidemark-code")
        spark.sparkContext.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(application)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without one; it gets a fresh temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return os.path.join(shared_folder(spark), "tidemark", f"{name}-{uuid.uuid4().hex}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of any file system that Spark reaches; nothing happens if it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if there is no folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove_all(spark: SparkSession, paths: Iterable[str], workers: int = 16) -> int:
    """Delete many paths, a bounded number at a time."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return sum(1 for _ in pool.map(lambda path: remove(spark, path), paths))


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write once under the shared folder and read back: a cut in the lineage that outlives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._stored_at = path
    return kept


def discard(df: DataFrame) -> None:
    """Delete what :func:`stored` wrote for this table; nothing may read it any more."""
    if path := getattr(df, "_stored_at", None):
        remove(df.sparkSession, path)


def broadcast_if_small(table: DataFrame, rows: int) -> DataFrame:
    """Broadcast a stored table that has at most ``rows`` rows; a larger one is joined by shuffle.

    Counting a stored table reads file footers only.
    """
    return F.broadcast(table) if table.count() <= rows else table
