"""Duplicates by key, first copy in input order stays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], *, scope: Sequence[str] = ()
) -> DataFrame:
    """One row per key. Null keys equal each other. ``scope`` columns narrow what is compared.

    The row-number limit is applied on the map side as well, so each task sends at most one
    row per key and a key that holds a third of the rows does not gather in one task.
    """
    window = W.partitionBy(*scope, *keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def flag_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    scope: Sequence[str] = (),
    column: str = "is_duplicate",
) -> DataFrame:
    """Mark every row but the first of its key, and keep them all.

    ``order`` must tell rows apart. The first order value per key comes from a narrow
    aggregation with map-side combine and is joined back; one key then has a single row on
    that side, so the skew join can split a hot key on the other.
    """
    # Structs of nulls equal each other, and one column serves the aggregation and the join.
    tagged = df.withColumn("_key", F.struct(*scope, *keys))
    firsts = tagged.groupBy("_key").agg(F.min(F.struct(*order)).alias("_first"))
    return (
        tagged.join(firsts, "_key").withColumn(column, F.struct(*order) != F.col("_first")).drop("_key", "_first")
    )
