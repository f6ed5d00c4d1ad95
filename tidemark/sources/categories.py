"""The list of known categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as C


def default_categories(spark: SparkSession, names: Sequence[str] = C.CATEGORIES) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "category STRING")


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """The items of a plain YAML list file (``- name`` lines)."""
    item = F.regexp_extract("value", r"""^\s*-\s+["']?(.*?)["']?\s*$""", 1)
    return spark.read.text(path).select(item.alias("category")).filter("category <> ''")
