"""Connected components: union-find within tasks, star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import column, record
from tidemark.session import discard, stored

BLOCK_EDGES = 200_000


def spanning_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges with the smallest node of its component, by union-find."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    roots = [find(x) for x in nodes]
    nodes, roots = np.array(nodes, np.int64), np.array(roots, np.int64)
    return nodes[nodes != roots], roots[nodes != roots]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK_EDGES:
            yield _forest(held)
            held, n = [], 0
    if n:
        yield _forest(held)


def _forest(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    a, b = spanning_edges(*(np.concatenate([column(x, c).to_numpy() for x in batches]) for c in ("a", "b")))
    return record(a=a, b=b)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node``, ``root``: every node of an edge but the smallest of its component, which is the root.

    Edges with a null end or equal ends count for nothing. Each round is written to the shared
    folder; the number of rounds grows with the logarithm of the number of nodes.
    """
    named = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a != b")
    current, before = stored(named.mapInArrow(_contract, "a long, b long"), "edges"), None
    while True:
        last, current = current, stored(_small_star(_large_star(current)), "stars")
        discard(last)
        now = tuple(current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
