"""Writing tables. All writes are task-parallel and may be repeated without adding rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.session import OPEN_FILES, remove_all, settings

QUARANTINE_SCHEMA = "source_file STRING, reason STRING, failed_at TIMESTAMP, record STRING"


def spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring the rows of one output partition together, but split a large one over tasks."""
    return df.hint("rebalance", *columns)


def write_partitioned(
    df: DataFrame, root: str, layout: Sequence[str] = C.LAYOUT, *, max_rows: int = 0, rebalance: bool = True, codec: str = C.COMPRESSION,
    add: bool = False,
) -> None:
    """Replace the output partitions the rows belong to, or ``add`` to them; all other partitions stay.

    Rebalanced, or as they were scanned, a task has few partitions, and no need to sort its rows by partition.
    """
    out = spread(df, layout) if rebalance else df
    with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES}):
        (
            out.write.mode("append" if add else "overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", codec)
            .option("maxRecordsPerFile", max_rows)
            .partitionBy(*layout)
            .parquet(root)
        )


def _folder(spark: SparkSession, column: str, value: str) -> str:
    """Name of an output partition, as Spark writes it."""
    return f"{column}=" + spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def clear_run(spark: SparkSession, root: str, run_id: str, file_ids: Iterable[str], workers: int = 16) -> None:
    """Take the rows of some files out of one run's side table."""
    base = f"{root}/{_folder(spark, 'run_id', run_id)}/"
    remove_all(spark, (f"{base}file_id={i}" for i in file_ids), workers)


def write_files(df: DataFrame, root: str, run_id: str, *, rebalance: bool = True, codec: str = C.COMPRESSION) -> None:
    """Write a side table with ``file_id``; a repeated run replaces the rows of its own files only."""
    write_partitioned(df.withColumn("run_id", F.lit(run_id)), root, ["run_id", "file_id"], rebalance=rebalance, codec=codec)


def write_run(df: DataFrame, root: str, run_id: str) -> None:
    """Write a side table of one run; a repeated run replaces its own rows.

    The rows are evened out first: a scan with very many tasks would leave as many small files.
    """
    out = df.hint("rebalance").withColumn("run_id", F.lit(run_id))
    write_partitioned(out, root, ["run_id"], rebalance=False)


def convert(df: DataFrame, path: str, max_rows: int = C.CHUNK_ROWS) -> None:
    """Rows as they are scanned, without cleaning, in parts of at most ``max_rows``."""
    (
        df.write.mode("overwrite")
        .option("compression", C.COMPRESSION)
        .option("maxRecordsPerFile", max_rows)
        .parquet(path)
    )


def compact(df: DataFrame, path: str) -> None:
    """Few large files instead of many small ones; the size is the advisory partition size.

    Rows that are read from files as they are go from task to writer, and a task reads as many files as make up a large one. Others
    are shuffled.
    """
    spark, files = df.sparkSession, _reads_files(df)
    # Files count by their size alone, whatever their number and that of the cores.
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    whole = {
        "spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1",
    }
    out = df if files else df.hint("rebalance")
    with settings(spark, whole if files else {}):
        out.write.mode("overwrite").option("compression", C.COMPRESSION).parquet(path)


def _reads_files(df: DataFrame) -> bool:
    """Whether a table is rows of files and nothing else: none left out, none added."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.child()
    return plan.children().isEmpty() and bool(df.inputFiles())


def first_chunk(df: DataFrame) -> DataFrame:
    """The sample of a table: the rows of chunk 0 of every file."""
    return df.filter(F.col("chunk_idx") == 0)


def write_sample(df: DataFrame, root: str, *, only_absent: bool = False) -> None:
    """Samples by category, replacing the categories present or adding only the absent ones."""
    sample = first_chunk(df)
    if only_absent:
        sample = absent_categories(sample, root)
    write_partitioned(sample, root, ["category"])


def absent_categories(sample: DataFrame, root: str) -> DataFrame:
    """Rows of the categories that have no stored sample yet."""
    try:
        stored = sample.sparkSession.read.parquet(root)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return sample
        raise
    known = stored.select(F.col("category").cast("string").alias("category")).distinct()
    return sample.join(known, "category", "left_anti")


def quarantine(rejects: DataFrame, failed_at: datetime, record: str = "_record") -> DataFrame:
    """Rejected rows: where they came from, why, when, and the row as JSON text."""
    return rejects.select(
        *[c for c in ("file_id", "claim") if c in rejects.columns],
        "source_file",
        "reason",
        F.lit(failed_at).cast("timestamp").alias("failed_at"),
        F.col(record).alias("record"),
    )


def write_documents(records: DataFrame, root: str) -> None:
    """Quarantine as JSON lines, one folder per source file."""
    spread(records, ["source_file"]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("source_file").json(root)
