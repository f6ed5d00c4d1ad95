"""File inventory. The listing is a scan that never opens a file's content."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PLAIN_NAME = r"([^/]+)$"


def logical_name(path: Column, pattern: str = PLAIN_NAME, *, encoded: bool = False) -> Column:
    """Name of the file a path belongs to: by default its last part.

    A dump delivered as a folder of parts has its name in the folder; ``pattern`` picks it.
    ``encoded`` says that the path is a URI, as in the ``_metadata`` column.
    """
    name = F.regexp_extract(path, pattern, 1)
    if not encoded:
        return name
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(name, F.lit("%")), decoded).otherwise(name)


def file_id(path: Column, *, encoded: bool = False) -> Column:
    """16 hex digits that stand for the physical file, however its path is written."""
    plain = F.regexp_replace(path, r"^([a-z][a-z0-9+.-]*):/+", "$1:/")
    if encoded:
        decoded = F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))
        plain = F.when(F.contains(plain, F.lit("%")), decoded).otherwise(plain)
    return F.lower(F.lpad(F.hex(F.xxhash64(plain)), 16, "0"))


def literal(path: str) -> str:
    """A path for readers that take patterns, which stands for itself."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def list_files(
    spark: SparkSession,
    root: str | Sequence[str],
    suffix: str = "",
    *,
    recursive: bool = True,
    name_pattern: str = PLAIN_NAME,
) -> DataFrame:
    """Files below ``root`` whose name ends in ``suffix``: path, source_file, length, modified_at."""
    roots = [root] if isinstance(root, str) else list(root)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(roots)
        .select(
            "path",
            logical_name(F.col("path"), name_pattern).alias("source_file"),
            F.col("length").alias("length"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def discover(
    spark: SparkSession, folder: str, suffix: str = ".tsv", *, name_pattern: str = PLAIN_NAME, recursive: bool = False
) -> DataFrame:
    """Inventory of one folder, not recursive by default; no match is an error."""
    files = list_files(spark, folder, suffix, recursive=recursive, name_pattern=name_pattern)
    if files.isEmpty():
        raise FileNotFoundError(f"no *{suffix} file in {folder}")
    return files
