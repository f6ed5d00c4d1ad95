"""Which files have been processed, as a table of events. The latest event of a file counts.

Events are only ever appended, so writers do not overwrite each other. A file is known by its path;
events without one, as of a dataset, by their name. Which event is the latest follows from ``seq``: the
version of the log that has it, and neither the clock of the writer nor ``updated_at``, the logical time of a run.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.operators.observe import LINEAGE_SCHEMA
from tidemark.state import versions

# ``processed`` is null for an event that forgets the file.
LOGGED = "file_name STRING, path STRING, processed BOOLEAN, updated_at TIMESTAMP"
SCHEMA = f"{LOGGED}, seq BIGINT"
# Events of before there was a log have a clock as ``seq``; all versions come behind.
FIRST_VERSION = 1 << 62


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or an empty one if it does not exist. Every other error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def load(spark: SparkSession, path: str, *, snapshots: bool = True) -> DataFrame:
    """The events that tell the current state; without ``snapshots`` all there have been."""
    logged = versions.read(spark, path, LOGGED, snapshots=snapshots)
    older = read_or_empty(spark, path, SCHEMA)
    return older.unionByName(logged.withColumn("seq", F.lit(FIRST_VERSION) + F.col("version")).drop("version"))


def _last_logged(events: DataFrame) -> DataFrame:
    """Of each file the event that counts, with its version; also of forgotten files."""
    order = F.struct("version", F.col("processed").isNull().alias("forgets"), "updated_at", "processed")
    last = events.groupBy("file_name", "path").agg(F.max(order).alias("last"))
    return last.select("file_name", "path", "last.processed", "last.updated_at", "last.version")


def snapshot(spark: SparkSession, path: str) -> int:
    """Keep the current state, so that readers need not open older commits; returns the version it stands for."""
    return versions.snapshot(spark, path, LOGGED, _last_logged)


def latest(events: DataFrame) -> DataFrame:
    """Current state: the last event of each file, forgotten files left out."""
    # Of events at one moment, the one that forgets the file counts.
    order = F.struct("seq", F.col("processed").isNull().alias("forgets"), "updated_at", "processed")
    return (
        events.groupBy("file_name", "path")
        .agg(F.max(order).alias("last"))
        .select("file_name", "path", F.col("last.processed").alias("processed"), F.col("last.updated_at").alias("updated_at"))
        .filter("processed IS NOT NULL")
    )


def marks(files: DataFrame, at: datetime, processed: bool | None = True) -> DataFrame:
    """Events for the rows of a file table: ``source_file`` and, if it has one, ``path``."""
    path = F.col("path") if "path" in files.columns else F.lit(None).cast("string")
    return files.select(
        F.col("source_file").alias("file_name"),
        path.alias("path"),
        F.lit(processed).cast("boolean").alias("processed"),
        F.lit(at).cast("timestamp").alias("updated_at"),
        F.lit(time.time_ns()).alias("seq"),
    ).distinct()


def append(events: DataFrame, path: str) -> int:
    """Commit events as the next version, which is returned."""
    spark = events.sparkSession
    columns = [c.split()[0] for c in LOGGED.split(", ")]
    return versions.commit(spark, path, events.select(*columns), latest=_last_logged)


def _names(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "source_file STRING")


def mark_processed(spark: SparkSession, path: str, names: Sequence[str], at: datetime) -> None:
    append(marks(_names(spark, names), at), path)


def reset(spark: SparkSession, path: str, names: Sequence[str], at: datetime) -> None:
    """Forget files by name, so that the next run takes them again, all parts of a name."""
    known = load(spark, path).join(_names(spark, names), F.col("file_name") == F.col("source_file"))
    append(marks(known.select("source_file", "path"), at, None), path)


def pending(inventory: DataFrame, events: DataFrame) -> DataFrame:
    """Files of the inventory that have not been processed, by path where it has one."""
    done = latest(events).filter("processed")
    if "path" in inventory.columns:
        return inventory.join(done.select("path"), "path", "left_anti")
    return inventory.join(done.select(F.col("file_name").alias("source_file")), "source_file", "left_anti")


def known_files(events: DataFrame) -> DataFrame:
    """All files that have a state, whatever it is."""
    return latest(events).select("file_name")


def is_processed(events: DataFrame, name: str) -> bool:
    return not latest(events.filter(F.col("file_name") == name)).filter("processed").isEmpty()


def dataset_complete(events: DataFrame, key: str = C.DATASET_KEY) -> bool:
    return is_processed(events, key)


def read_manifest_json(spark: SparkSession, path: str, at: datetime) -> DataFrame:
    """Events from a manifest document ``{file: {"processed": true}}``; none if it is absent."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], SCHEMA)
        raise
    entries = F.explode(F.from_json("value", "map<string, struct<processed: boolean>>"))
    return text.select(entries.alias("file_name", "state")).select(
        "file_name",
        F.lit(None).cast("string").alias("path"),
        F.coalesce("state.processed", F.lit(False)).alias("processed"),
        F.lit(at).cast("timestamp").alias("updated_at"),
        F.lit(time.time_ns()).alias("seq"),
    )


def read_lineage_json(spark: SparkSession, path: str) -> DataFrame:
    """Lineage records from a JSON list; none if it is absent."""
    try:
        return spark.read.schema(LINEAGE_SCHEMA).option("multiLine", True).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LINEAGE_SCHEMA)
        raise
