"""What is bought together: exact counts of pairs, whatever the size of a basket.

Items of few baskets go first, since no pair of theirs can reach the support asked for. A basket is dealt out in blocks, and
each two blocks of it meet in a row of their own, so the pairs of a large one are made by many tasks in bounded
arrays. Pairs are counted where they are made before they are sent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import stored

# Items in a block of a basket: a row holds two blocks and makes at most the square of this.
BLOCK = 512


def frequent_items(rows: DataFrame, basket: str, item: str, support: int) -> DataFrame:
    """Distinct rows of basket and item, items of fewer than ``support`` baskets left out; null ones count for nothing."""
    lines = rows.select(F.col(basket).alias("basket"), F.col(item).alias("item")).where("basket IS NOT NULL AND item IS NOT NULL")
    lines = stored(lines.distinct(), "baskets")
    often = lines.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= support)
    return lines.join(often, "item")


def _meetings(lines: DataFrame, block: int) -> DataFrame:
    """Rows with the items of two blocks of a basket, or of one block twice."""
    sizes = lines.groupBy("basket").agg(F.count("*").alias("size")).where("size > 1")
    sizes = sizes.select("basket", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    dealt = lines.join(sizes, "basket").withColumn("own", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    named = met.select("basket", lo.alias("lo"), hi.alias("hi"), "own", "item")
    side = lambda end: F.collect_list(F.when(F.col("own") == F.col(end), F.col("item")))
    return named.groupBy("basket", "lo", "hi").agg(side("lo").alias("x"), side("hi").alias("y"))


def pair_counts(rows: DataFrame, basket: str, item: str, *, support: int = 2, block: int = BLOCK) -> DataFrame:
    """In how many baskets two items are together: ``a`` below ``b``, ``together``; at least ``support`` times."""
    met = _meetings(frequent_items(rows, basket, item, support).select("basket", "item"), block)
    # Two steps, so that no array is longer than a block.
    one = met.select("lo", "hi", F.explode("x").alias("p"), "y").select("lo", "hi", "p", F.explode("y").alias("q"))
    pairs = one.where("lo < hi OR p < q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("together")).where(F.col("together") >= support)


def bought_together(rows: DataFrame, basket: str, item: str, k: int = 5, *, support: int = 2, block: int = BLOCK) -> DataFrame:
    """For each item the ``k`` others that are with it in the most baskets: ``item``, ``rank``, ``other``, ``together``."""
    counted = stored(pair_counts(rows, basket, item, support=support, block=block), "pairs")
    both = counted.select(F.col("a").alias("item"), F.col("b").alias("other"), "together").union(counted.select("b", "a", "together"))
    order = F.row_number().over(W.partitionBy("item").orderBy(F.desc("together"), "other"))
    return both.withColumn("rank", order).where(F.col("rank") <= k)
