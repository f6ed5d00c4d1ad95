"""Passages of texts, and the passages nearest to query vectors."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import ship_package

# Similarities that are held at once, vectors times queries.
CELLS = 4_000_000


def passages(df: DataFrame, key: str, text: str, size: int = 128, step: int = 96) -> DataFrame:
    """Windows of ``size`` words that start every ``step`` words and cover the whole text."""
    tokens = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    split = df.select(key, tokens.alias("tokens")).filter(F.size("tokens") > 0)
    # The last window is the first one that reaches the end.
    last = F.greatest(F.ceil((F.size("tokens") - size) / step), F.lit(0)).cast("int")
    windows = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", F.slice(F.col("tokens"), i * step + 1, size))
    )
    return split.select(key, F.posexplode(windows).alias("passage_no", "passage"))


def _unit(values: Sequence[float]) -> np.ndarray:
    vector = np.asarray(values, float)
    length = np.sqrt(np.square(vector).sum())
    return vector / length if length else vector


def _best(similarity: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Query numbers and rows of the ``k`` largest of each query (a row each); ties go to the smaller key."""
    queries, rows = [], []
    for q, own in enumerate(similarity):
        if len(own) > k:
            near = np.flatnonzero(own >= np.partition(own, len(own) - k)[len(own) - k])
        else:
            near = np.arange(len(own))
        order = near[np.lexsort((keys[near], -own[near]))][:k]
        queries.append(np.full(len(order), q))
        rows.append(order)
    return np.concatenate(queries), np.concatenate(rows)


def nearest(
    corpus: DataFrame, key: str, vector: str, queries: Mapping[object, Sequence[float]], k: int = 10
) -> DataFrame:
    """The ``k`` nearest rows of the corpus for each query vector, by cosine.

    Exact: every row is compared with every query, in one pass over the corpus for any number of
    queries, by multiplying blocks of vectors with the matrix of queries. A task sends ``k`` rows
    per query and block. Ranks follow the whole value; it is rounded for display. Rows whose vector
    is null, zero, of another length or holds nulls take no part.
    """
    spark = corpus.sparkSession
    ship_package(spark)
    names = list(queries)
    kind = "BIGINT" if all(isinstance(name, int) for name in names) else "STRING"
    wanted = spark.sparkContext.broadcast(np.stack([_unit(queries[name]) for name in names]))
    key_type = corpus.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = wanted.value
        step = max(1, CELLS // len(units))
        for batch in batches:
            keys = batch.column(0)
            matrix = np.asarray(batch.column(1).flatten(), float).reshape(-1, units.shape[1])
            length = np.sqrt(np.square(matrix).sum(axis=1))
            for a in range(0, len(matrix), step):
                live = a + np.flatnonzero(length[a : a + step] > 0)
                if not len(live):
                    continue
                order = keys.to_numpy(zero_copy_only=False)[live]
                query, row = _best(units @ (matrix[live] / length[live, None]).T, order, k)
                value = np.einsum("ij,ij->i", units[query], matrix[live[row]]) / length[live[row]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[q] for q in query]), keys.take(pa.array(live[row])), pa.array(value)], ["query", key, "similarity"]
                )

    whole = F.col(vector).cast("array<double>")
    usable = (F.size(vector) == wanted.value.shape[1]) & ~F.exists(whole, lambda x: x.isNull())
    rows = corpus.where(usable).select(F.col(key), whole.alias("_v"))
    found = rows.mapInArrow(run, f"query {kind}, `{key}` {key_type}, similarity DOUBLE")
    window = W.partitionBy("query").orderBy(F.desc("similarity"), key)
    ranked = found.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return ranked.withColumn("similarity", F.round("similarity", 6))
