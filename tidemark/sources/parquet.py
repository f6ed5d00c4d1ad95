"""Reading stored parts back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stored
from tidemark.sources.files import file_id, list_files, literal
from tidemark.state import attempts

PARTITION_TYPES = {
    "year": T.IntegerType(),
    "month": T.StringType(),
    "category": T.StringType(),
    "source_file": T.StringType(),
    "file_id": T.StringType(),
    "attempt": T.StringType(),
}


def read_dataset(spark: SparkSession, root: str) -> DataFrame:
    """A partitioned dataset; partition values keep their text, so month ``01`` stays ``01``.

    Of a table whose files are published in attempts the live rows are read, as of this moment.
    """
    rows = _typed(spark, root)
    if "attempt" not in rows.columns:
        return rows
    return attempts.live_rows(rows, attempts.live(spark, root)).drop("attempt")


def _typed(spark: SparkSession, root: str) -> DataFrame:
    found = spark.read.parquet(root).schema
    typed = [T.StructField(f.name, PARTITION_TYPES.get(f.name, f.dataType), True) for f in found]
    return spark.read.schema(T.StructType(typed)).parquet(root)


def read_attempts(spark: SparkSession, root: str, live: DataFrame, *, places: bool = False) -> DataFrame | None:
    """The rows of a table that belong to the attempts given; None if nothing is stored.

    With ``places``, ``_path`` and ``_row`` tell where a row is stored.
    """
    try:
        rows = _typed(spark, root)
        if places:
            rows = rows.withColumns({"_path": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
        return attempts.live_rows(rows, live).drop("attempt")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_category(spark: SparkSession, root: str, category: str) -> DataFrame:
    """The parts of one category; only that partition is read. No row is an error."""
    df = read_dataset(spark, root).filter(F.col("category") == category)
    if df.isEmpty():
        raise FileNotFoundError(f"no part of {category} in {root}")
    return df


def read_first_files(spark: SparkSession, root: str, n: int = 5, suffix: str = ".parquet") -> DataFrame:
    """The first ``n`` files by path; one that cannot be read is skipped. :func:`probe_files` tells which these are."""
    chosen = [r.path for r in list_files(spark, root, suffix).orderBy("path").limit(n).select("path").collect()]
    if not chosen:
        raise FileNotFoundError(f"no *{suffix} file in {root}")
    return (
        spark.read.option("ignoreCorruptFiles", True).option("basePath", root).option("mergeSchema", True).parquet(*chosen)
    )


def probe_files(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """One row per file below ``root``: ``path``, ``source_file``, ``n_rows``, ``readable`` and the ``error``, found in tasks.

    Footers are read for all files. Only those that give no row, which are empty or broken, are opened besides,
    to look for the marks at both ends. A page that is broken within a file is not found, and a file without any
    bytes is not listed.
    """
    listed = list_files(spark, root, suffix).select("path", "source_file", "length", file_id(F.col("path")).alias("_id"))
    rows = spark.read.option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    # The schema is not asked for: no column is read, and one file that is broken cannot stop the others.
    counted = rows.schema("_none INT").parquet(root).select(file_id(F.col("_metadata.file_path"), encoded=True).alias("_id"))
    found = stored(listed.join(counted.groupBy("_id").agg(F.count("*").alias("n_rows")), "_id", "left"), "footers")
    silent = [r.path for r in found.where("n_rows IS NULL").select("path").collect()]
    ends = spark.createDataFrame([], "_id STRING, marked BOOLEAN")
    if silent:
        content = spark.read.format("binaryFile").load([literal(p) for p in silent])
        mark = F.lit(b"PAR1")
        marked = (F.substring("content", 1, 4) == mark) & (F.substring("content", -4, 4) == mark) & (F.col("length") > 8)
        ends = content.select(file_id(F.col("path")).alias("_id"), marked.alias("marked"))
    error = F.when(~F.col("readable"), "no footer")
    return (
        found.join(ends, "_id", "left")
        .withColumn("readable", F.col("n_rows").isNotNull() | F.coalesce("marked", F.lit(False)))
        .select("path", "source_file", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "readable", error.alias("error"))
    )
