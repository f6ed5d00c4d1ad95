"""Sentiment learned from star ratings: naive Bayes over words and pairs of words, counted, calibrated and applied in Spark.

The model is counts, so fitting is one aggregation with a map-side combine, and weights are whole numbers of a millionth: scores
are sums that come out alike in any order. A text is scored by joining its terms to the weights. These are sent to the texts, so no term of
a text is shuffled; of a larger model a term that is in a third of all texts is one row, so the skew join can split the texts. No Python runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import broadcast_if_small, stored

MICRO = 1_000_000
# Terms of fewer texts than this tell nothing.
LEAST_TEXTS = 2
# A model of up to this many terms (about 100 bytes each) is broadcast.
BROADCAST_TERMS = 2_000_000
SMOOTHING = 1.0
# Calibration: one bin per so many millionths of a score, outer ones hold all beyond.
BIN_WIDTH, BINS = 2_000_000, 10


def terms(text: Column, pairs: bool = True) -> Column:
    """Distinct lower-case words, and pairs of neighbours."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}']+)"), 1)
    if not pairs:
        return F.array_distinct(words)
    next_ = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    joined = F.zip_with(F.slice(words, F.lit(1), F.size(next_)), next_, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.concat(words, joined))


def polarity(rating: Column) -> Column:
    """1 for four stars and more, 0 for two and fewer, null between."""
    return F.when(rating >= 4, 1).when(rating <= 2, 0)


@dataclass(frozen=True)
class LearnedSentiment:
    """``weights`` of terms (``term``, ``weight``), the weight of having no term, and the share of good texts in each bin.

    ``shares`` has at most ``2 * BINS`` rows: ``bin``, ``n``, ``n_good``, ``probability``.
    """

    weights: DataFrame
    prior: int
    shares: DataFrame | None = None
    pairs: bool = True


def _exploded(rows: DataFrame, key: str, text: str, pairs: bool, *also: str) -> DataFrame:
    return rows.select(key, *also, F.explode(terms(F.col(text), pairs)).alias("term"))


def _micro(value: Column) -> Column:
    return F.round(value * MICRO).cast("long")


def fit(rows: DataFrame, key: str, text: str, rating: str, *, pairs: bool = True, least: int = LEAST_TEXTS) -> LearnedSentiment:
    """Learn from the rows with a clear rating. A term counts once per text."""
    labelled = rows.withColumn("_good", polarity(F.col(rating))).where(f"_good IS NOT NULL AND {text} IS NOT NULL")
    counted = _exploded(labelled, key, text, pairs, "_good").groupBy("term").agg(
        F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("bad")
    )
    counts = stored(counted.where(F.col("good") + F.col("bad") >= least), "terms")
    # Two rows of totals.
    n = labelled.agg(F.coalesce(F.sum("_good"), F.lit(0)).alias("good"), F.coalesce(F.sum(1 - F.col("_good")), F.lit(0)).alias("bad")).first()
    total = counts.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.count("*").alias("terms")).first()
    size = SMOOTHING * total["terms"]
    share = lambda side: (F.col(side) + SMOOTHING) / ((total[side] or 0) + size)
    weights = counts.select("term", _micro(F.log(share("good") / share("bad"))).alias("weight"))
    prior = counts.sparkSession.range(1).select(_micro(F.log(F.lit((n["good"] + 1.0) / (n["bad"] + 1.0)))).alias("p")).first()["p"]
    return LearnedSentiment(weights, prior, None, pairs)


def scores(rows: DataFrame, key: str, text: str, model: LearnedSentiment) -> DataFrame:
    """``key`` and ``score`` in millionths: above 0 is good. Keys are distinct; a null text has no row."""
    present = rows.where(F.col(text).isNotNull())
    hit = _exploded(present, key, text, model.pairs).join(broadcast_if_small(model.weights, BROADCAST_TERMS), "term")
    sums = hit.groupBy(key).agg(F.sum("weight").alias("_sum"))
    return present.select(key).join(sums, key, "left").select(key, (F.coalesce("_sum", F.lit(0)) + model.prior).alias("score"))


def bin_of(score: Column) -> Column:
    return F.greatest(F.least(F.floor(score / BIN_WIDTH), F.lit(BINS - 1)), F.lit(-BINS)).cast("int")


def calibrate(rows: DataFrame, key: str, text: str, rating: str, model: LearnedSentiment) -> LearnedSentiment:
    """Count, on rows that were not learned from, how often a score of each bin belongs to a good text."""
    labelled = rows.withColumn("_good", polarity(F.col(rating))).where("_good IS NOT NULL")
    binned = scores(labelled, key, text, model).join(labelled.select(key, "_good"), key).groupBy(bin_of(F.col("score")).alias("bin"))
    shares = binned.agg(F.count("*").alias("n"), F.sum("_good").alias("n_good"))
    probability = (F.col("n_good") + 1) / (F.col("n") + 2)
    return LearnedSentiment(model.weights, model.prior, stored(shares.withColumn("probability", probability), "shares"), model.pairs)


def with_probability(scored: DataFrame, model: LearnedSentiment) -> DataFrame:
    """Add ``probability``; where no calibrated score was like it, one half moved by the sign of the score."""
    known = model.shares.select(F.col("bin").alias("_bin"), "probability")
    joined = scored.withColumn("_bin", bin_of(F.col("score"))).join(F.broadcast(known), "_bin", "left").drop("_bin")
    guess = F.when(F.col("score") > 0, 2 / 3).when(F.col("score") < 0, 1 / 3).otherwise(0.5)
    return joined.withColumn("probability", F.coalesce("probability", guess))
