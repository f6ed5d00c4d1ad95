"""Nearest vectors by multi-index hashing of learned binary codes.

Codes are signs of rotated vectors; the rotations are learned so that signs lose little. A code is
cut into bytes, and each byte has its own index. If two codes differ in at most ``r`` bits, some
byte differs in few, so probing every byte's index around the query's byte finds every code within
the radius. What is found is ranked by exact distance.

The corpus is dealt out in shards, each with its own indexes, and every query goes to every shard,
as a block of bounded size. A shard answers with its ``k`` nearest, so nothing else is moved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.frames import column, record
from tidemark.session import stored

# Vectors that the rotations and the radius are learned from.
SAMPLE = 8192
SAMPLE_QUERIES = 256
ROTATIONS = 2
ROUNDS = 30
TARGET_RECALL = 0.985
SHARD = 8192
QUERY_BLOCK = 4096


@dataclass(frozen=True)
class Coder:
    """Codes of ``bits`` bits: signs of ``(vector - mean) @ rotation``."""

    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One row of bytes per vector."""
        return np.packbits((vectors - self.mean) @ self.rotation > 0, axis=1)


def _rotation(x: np.ndarray, bits: int, seed: int) -> np.ndarray:
    """Principal directions, turned until the signs are as close to the values as they get."""
    _, directions = np.linalg.eigh(x.T @ x)
    directions = directions[:, ::-1][:, :bits]
    projected = x @ directions
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(directions.shape[1],) * 2))
    for _ in range(ROUNDS):
        u, _, v = np.linalg.svd(np.where(projected @ turn > 0, 1.0, -1.0).T @ projected)
        turn = (u @ v).T
    return directions @ turn


def learn_coder(sample: np.ndarray, k: int, rotations: int = ROTATIONS, recall: float = TARGET_RECALL) -> Coder:
    """Rotations from the sample, and the radius within which its own neighbours lie."""
    mean = sample.mean(axis=0)
    parts = [_rotation(sample - mean, sample.shape[1], seed) for seed in range(rotations)]
    rotation = np.concatenate(parts, axis=1)
    # Whole bytes: directions that are too many are left out, missing ones are never set.
    rotation = np.pad(rotation, ((0, 0), (0, -rotation.shape[1] % 8)))
    coder = Coder(mean, rotation, 0)
    codes = coder.codes(sample)
    far = []
    for i in range(min(SAMPLE_QUERIES, len(sample))):
        distance = np.square(sample - sample[i]).sum(axis=1)
        distance[i] = np.inf
        near = np.argsort(distance, kind="stable")[: min(k, len(sample) - 1)]
        far.append(np.bitwise_count(codes[near] ^ codes[i]).sum(axis=1, dtype=int))
    far = np.concatenate(far) if far else np.zeros(1, int)
    radius = int(np.quantile(far, recall, method="higher")) if len(far) else rotation.shape[1]
    return Coder(mean, rotation, radius)


# All bytes with at most so many set bits.
_FLIPS = [np.array([b for b in range(256) if bin(b).count("1") <= n], np.uint8) for n in range(9)]


class Shard:
    """The indexes of some vectors: for each byte of the code, the vectors in order of that byte."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        self.ids, self.vectors, self.codes = ids, vectors, codes
        self.order = [np.argsort(codes[:, s], kind="stable") for s in range(codes.shape[1])]
        self.starts = [np.searchsorted(codes[o, s], np.arange(257)) for s, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Places of all vectors whose code differs from this one in at most ``radius`` bits."""
        seen = np.zeros(len(self.ids), bool)
        each, more = divmod(radius, len(code))
        for s, (order, starts) in enumerate(zip(self.order, self.starts)):
            flips = each if s <= more else each - 1
            if flips < 0:
                continue
            probes = code[s] ^ _FLIPS[min(8, flips)]
            lo = starts[probes]
            count = starts[probes.astype(int) + 1] - lo
            at = np.arange(count.sum()) + np.repeat(lo - (np.cumsum(count) - count), count)
            seen[order[at]] = True
        found = np.flatnonzero(seen)
        return found[np.bitwise_count(self.codes[found] ^ code).sum(axis=1, dtype=int) <= radius]

    def nearest(self, ident: int, vector: np.ndarray, code: np.ndarray, radius: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the ``k`` nearest within the radius, which grows until there are enough."""
        own = int((self.ids == ident).sum())
        while True:
            found = self.within(code, radius)
            if len(found) - own >= k or radius >= 8 * len(code):
                break
            radius += len(code)
        found = found[self.ids[found] != ident]
        distance = np.sqrt(np.square(self.vectors[found] - vector).sum(axis=1))
        if len(found) > k:
            keep = distance <= np.partition(distance, k - 1)[k - 1]
            found, distance = found[keep], distance[keep]
        best = np.lexsort((self.ids[found], distance))[:k]
        return self.ids[found[best]], distance[best]


def _usable(vector: Column) -> Column:
    """Has components, all of them finite, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    return np.asarray(vectors.flatten(), np.float64).reshape(-1, size)


def nearest_neighbours(
    vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    sample: int = SAMPLE, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The ``k`` nearest rows of each row for which ``queries`` holds: ``query_id``, ``rank``, ``vec_id``, ``score``.

    ``score`` is the Euclidean distance in double precision; ties go to the smaller id. Every row is
    a candidate but those with the query's own id. Rows with a null id, or whose vector is null,
    zero, of another length than most, or holds a null or a non-finite number, take no part. Rows that
    repeat an id and its vector count once.
    The coder is learned from ``sample`` vectors, those with the smallest hash of the id; all are indexed.
    """
    spark = vectors.sparkSession
    cells = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), cells.alias("vector"), queries.alias("asked"))
    rows = rows.where(F.col("id").isNotNull() & _usable(F.col("vector")))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    common = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return empty
    size = common["size"]
    rows = stored(rows.where(F.size("vector") == size).dropDuplicates(["id", "vector"]), "vectors")
    taken = rows.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
    coder = learn_coder(_matrix(taken.column("vector").combine_chunks(), size), k)
    asked = rows.where("asked").select("id", "vector")
    blocks = math.ceil(asked.count() / query_block)
    block_of = F.pmod(F.xxhash64("id"), F.lit(max(1, blocks)))
    answers = empty.select("query_id", "vec_id", "score")
    for block in range(blocks):
        part = asked.where(block_of == block).toArrow()
        found = _search(rows, part.column("id").to_numpy(), _matrix(part.column("vector").combine_chunks(), size), coder, k)
        answers = answers.unionByName(stored(found, "answers"))
    best = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return answers.dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", best).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _search(rows: DataFrame, idents: np.ndarray, queries: np.ndarray, coder: Coder, k: int) -> DataFrame:
    """The best ``k`` of every task for every query of a block."""
    shared = rows.sparkSession.sparkContext.broadcast((idents, queries, coder.codes(queries), coder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, vectors_, codes, model = shared.value
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * len(names)

        def answer(held: list[pa.RecordBatch]) -> None:
            ids = np.concatenate([column(b, "id").to_numpy() for b in held])
            matrix = np.concatenate([_matrix(column(b, "vector"), vectors_.shape[1]) for b in held])
            for a in range(0, len(ids), SHARD):
                part = matrix[a : a + SHARD]
                shard = Shard(ids[a : a + SHARD], part, model.codes(part))
                for q in range(len(names)):
                    found, distance = shard.nearest(names[q], vectors_[q], codes[q], model.radius, k)
                    found, distance = np.append(best[q][0], found), np.append(best[q][1], distance)
                    order = np.lexsort((found, distance))[:k]
                    best[q] = found[order], distance[order]

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= SHARD:
                answer(held)
                held, n = [], 0
        if n:
            answer(held)
        for a in range(0, len(names), 1000):
            part = best[a : a + 1000]
            yield record(
                query_id=np.repeat(names[a : a + 1000], [len(f) for f, _ in part]),
                vec_id=np.concatenate([f for f, _ in part]), score=np.concatenate([d for _, d in part]),
            )

    return rows.select("id", "vector").mapInArrow(run, "query_id long, vec_id long, score double")
