"""Sentiment of a text: a word-list score in built-ins, or a model of the caller's own."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSITIVE, NEGATIVE, NEUTRAL = "POSITIVE", "NEGATIVE", "NEUTRAL"


@dataclass(frozen=True)
class Lexicon:
    """Words that count for and against."""

    positive: tuple[str, ...]
    negative: tuple[str, ...]


ENGLISH = Lexicon(
    positive=(
        "amazing", "awesome", "beautiful", "best", "comfortable", "delicious", "easy", "enjoy",
        "enjoyed", "excellent", "fantastic", "favorite", "fun", "glad", "good", "great", "happy",
        "helpful", "impressed", "like", "love", "loved", "nice", "perfect", "pleased", "recommend",
        "satisfied", "sturdy", "wonderful", "works",
    ),
    negative=(
        "annoying", "awful", "bad", "boring", "broke", "broken", "cheap", "defective", "difficult",
        "disappointed", "disappointing", "fail", "failed", "flimsy", "hate", "hated", "horrible",
        "junk", "poor", "problem", "refund", "return", "returned", "terrible", "ugly", "useless",
        "waste", "worse", "worst", "wrong",
    ),
)


def words(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.split(F.lower(text), r"[^\p{L}]+")


def hits(tokens: Column, chosen: Sequence[str]) -> Column:
    """How many of the words are in a list."""
    return F.size(F.filter(tokens, lambda w: w.isin(*chosen)))


def balance(good: Column, bad: Column) -> Column:
    """(good - bad) / (good + bad), 0 when there is neither."""
    return F.when(good + bad > 0, (good - bad) / (good + bad)).when(good + bad == 0, F.lit(0.0))


def label_of(score: Column) -> Column:
    return F.when(score > 0, F.lit(POSITIVE)).when(score < 0, F.lit(NEGATIVE)).when(score == 0, F.lit(NEUTRAL))


def with_sentiment(df: DataFrame, text: str, lexicon: Lexicon = ENGLISH) -> DataFrame:
    """Add ``score`` in [-1, 1] and ``label`` from the words of the whole text.

    Words and counts are columns of their own, so each is worked out once per row.
    """
    tokens = F.col("_words")
    counted = df.withColumn("_words", words(F.col(text))).withColumns(
        {"_good": hits(tokens, lexicon.positive), "_bad": hits(tokens, lexicon.negative)}
    )
    score = F.when(F.col(text).isNotNull(), balance(F.col("_good"), F.col("_bad")))
    scored = counted.withColumn("score", score)
    return scored.withColumn("label", label_of(F.col("score"))).drop("_words", "_good", "_bad")


Scorer = Callable[[list[str]], Sequence[tuple[str, float]]]


def with_model(df: DataFrame, text: str, load: Callable[[], Scorer]) -> DataFrame:
    """Add ``label`` and ``score`` from a model. ``load`` runs once per task, the model takes batches."""

    @F.pandas_udf("label STRING, score DOUBLE")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = load()
        for batch in batches:
            present = batch.notna()
            out = pd.DataFrame({"label": None, "score": float("nan")}, index=batch.index, dtype=object)
            if present.any():
                found = list(scorer(batch[present].tolist()))
                out.loc[present, "label"] = [label for label, _ in found]
                out.loc[present, "score"] = [float(score) for _, score in found]
            out["score"] = out["score"].astype("float64")
            yield out

    return df.withColumn("_s", classify(F.col(text))).select("*", "_s.label", "_s.score").drop("_s")
