"""Row numbers within large groups, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import broadcast_if_small, stored

# A count table with up to this many rows (a group name and four numbers each) is broadcast.
BROADCAST_PIECES = 500_000


def with_rank(df: DataFrame, group: str, order: Sequence[Column], column: str = "rank") -> DataFrame:
    """Add the 1-based place of a row in its group, in an order that tells rows apart.

    The rows are range-partitioned by group and order, so a large group spans many tasks. The
    sorted rows are stored, because a second sampling would cut them elsewhere; then the rows
    of each group per partition are counted and the counts summed up. The window runs over
    one row per partition and group.
    """
    placed = stored(
        df.repartitionByRange(F.col(group), *order)
        .sortWithinPartitions(F.col(group), *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranks",
    )
    pieces = placed.groupBy(group, "_part").agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    earlier = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    pieces = broadcast_if_small(stored(pieces, "pieces"), BROADCAST_PIECES)
    return (
        placed.join(pieces, [group, "_part"])
        .withColumn(column, F.col("_before") + F.col("_at") - F.col("_from") + 1)
        .drop("_part", "_at", "_from", "_before")
    )
