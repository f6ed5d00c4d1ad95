"""Hard negatives by a secondary sort: scores of pairs, packed into keys, sorted in the shuffle and read as a stream.

A pair's key is (anchor, falling score, kind, id) in bytes whose order is that of the numbers. Rows are dealt out by anchor
and sorted by key within the partitions. In this order an anchor's positives come before the negatives that are below
them, so one pass opens a window at each positive, fills it and closes it, and holds five windows of one anchor at most.

Every row is scored against every anchor, a block of anchors at a time, by a matrix product inside the tasks. What
cannot be among the results stays in the task that scored it: a task sends its best positives of an anchor and,
once the windows are known, the first negatives of each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.frames import column, record, values
from tidemark.session import stored

POSITIVES, NEGATIVES = 5, 10
# A negative scores from 30 to 90 hundredths of its positive.
LEAST_SHARE, MOST_SHARE = 30, 90
SCALE = 256
# Anchors scored in one pass over the rows, and cells of the matrix of scores a task holds.
ANCHOR_BLOCK = 16_384
CELLS = 1 << 20
# Candidates a task gathers before it keeps the best of each group.
GATHERED = 1 << 18

_SIGN = np.uint64(1 << 63)
POSITIVE, NEGATIVE = 0, 1


def packed_keys(anchor: np.ndarray, score: np.ndarray, kind: np.ndarray, ident: np.ndarray) -> pa.Array:
    """25 bytes a pair: anchor, falling score, kind, id. The order of the bytes is that of the numbers."""
    out = np.zeros((len(anchor), 25), np.uint8)

    def rising(x: np.ndarray) -> np.ndarray:
        return (np.asarray(x, np.int64).view(np.uint64) ^ _SIGN).astype(">u8").view(np.uint8).reshape(-1, 8)

    out[:, :8] = rising(np.ascontiguousarray(anchor))
    out[:, 8:16] = ~rising(np.ascontiguousarray(score))
    out[:, 16] = kind
    out[:, 17:] = rising(np.ascontiguousarray(ident))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(25), len(out), [None, pa.py_buffer(out)]).cast(pa.binary())


def unpacked_keys(keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    flat = np.frombuffer(b"".join(keys.to_pylist()), np.uint8).reshape(-1, 25)

    def back(part: np.ndarray) -> np.ndarray:
        return (np.ascontiguousarray(part).view(">u8").ravel().astype(np.uint64) ^ _SIGN).view(np.int64)

    return back(flat[:, :8]), back(~flat[:, 8:16]), flat[:, 16].astype(int), back(flat[:, 17:])


def _whole_numbers(vectors: pa.Array, scale: float) -> np.ndarray:
    made = np.floor(np.asarray(vectors.flatten(), np.float64) * scale)
    # Beyond this a product has no place in a long in any case.
    return np.clip(made, -(2.0**53), 2.0**53).reshape(len(vectors), -1)


def inner_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products of all rows of whole numbers, exact up to 63 bits; in doubles as long as these are exact."""
    most = (np.abs(x).max(initial=0)) * (np.abs(y).max(initial=0)) * x.shape[1]
    if most < 2.0**24:
        return (x.astype(np.float32) @ y.astype(np.float32).T).astype(np.int64)
    if most < 2.0**53:
        return (x @ y.T).astype(np.int64)
    return x.astype(np.int64) @ y.astype(np.int64).T


@dataclass(frozen=True)
class Anchors:
    """A block of anchors; ``windows`` has the scores of the positives of each, or none so far."""

    ids: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray
    windows: np.ndarray | None = None


class _Best:
    """The first ``k`` candidates of each group by falling score, then id; scores below a group's last one are not taken."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.least = np.full(groups, np.iinfo(np.int64).min)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        self.parts.append((group, score, ident))
        self.size += len(group)
        if self.size > max(GATHERED, 2 * self.k * len(self.least)):
            self.keep()

    def keep(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        group, score, ident = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((ident, -score, group))
        group, score, ident = group[order], score[order], ident[order]
        start = np.searchsorted(group, group, "left")
        place = np.arange(len(group)) - start
        last = place == self.k - 1
        self.least[group[last]] = score[last]
        first = place < self.k
        self.parts = [(group[first], score[first], ident[first])]
        self.size = int(first.sum())
        return self.parts[0]


def _scan(
    rows: DataFrame, anchors: Anchors, scale: float, groups: int, k: int, schema: str,
    pick: Callable[[Anchors, np.ndarray, np.ndarray, np.ndarray, _Best, int], None],
    result: Callable[[Anchors, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch],
) -> DataFrame:
    """Score all rows against a block of anchors; a task returns the best ``k`` of each group that ``pick`` offers."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        best = _Best(groups, k)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, labels = values(batch, "id"), values(batch, "label")
            matrix = _whole_numbers(column(batch, "vector"), scale)
            step = max(1, CELLS // len(ids))
            for a in range(0, len(block.ids), step):
                part = slice(a, a + step)
                pick(block, ids, labels, inner_products(matrix, block.matrix[part]), best, a)
        found = best.keep()
        if len(found[0]):
            yield result(block, *found)

    return rows.select("id", "label", "vector").mapInArrow(run, schema)


def _positives(rows: DataFrame, anchors: Anchors, scale: float, k: int) -> DataFrame:
    def pick(block: Anchors, ids: np.ndarray, labels: np.ndarray, scores: np.ndarray, best: _Best, a: int) -> None:
        to = a + scores.shape[1]
        fits = (labels[:, None] == block.labels[a:to]) & (ids[:, None] != block.ids[a:to]) & (scores >= best.least[a:to])
        row, col = np.nonzero(fits)
        best.add(col + a, scores[row, col], ids[row])

    def result(block: Anchors, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> pa.RecordBatch:
        return record(anchor=block.ids[group], score=score, id=ident)

    found = _scan(rows, anchors, scale, len(anchors.ids), k, "anchor long, score long, id long", pick, result)
    order = F.row_number().over(W.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    return found.withColumn("place", order).where(F.col("place") <= k)


def _negatives(rows: DataFrame, anchors: Anchors, scale: float, least: int, most: int, k: int) -> DataFrame:
    windows = anchors.windows.shape[1]

    def pick(block: Anchors, ids: np.ndarray, labels: np.ndarray, scores: np.ndarray, best: _Best, a: int) -> None:
        to = a + scores.shape[1]
        other = labels[:, None] != block.labels[a:to]
        hundred = 100 * scores
        for w in range(windows):
            positive = block.windows[a:to, w]
            group = np.arange(a, to) * windows + w
            fits = other & (least * positive <= hundred) & (hundred <= most * positive) & (scores >= best.least[group])
            row, col = np.nonzero(fits)
            best.add(group[col], scores[row, col], ids[row])

    def result(block: Anchors, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> pa.RecordBatch:
        # A row that is in several windows of an anchor is sent once.
        pairs = np.unique(np.stack([group // windows, -score, ident]), axis=1)
        anchor = block.ids[pairs[0]]
        return record(anchor=anchor, key=packed_keys(anchor, -pairs[1], np.full(len(anchor), NEGATIVE, np.uint8), pairs[2]))

    return _scan(rows, anchors, scale, len(anchors.ids) * windows, k, "anchor long, key binary", pick, result)


def _packed(positives: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor = values(batch, "anchor")
            kind = np.full(len(anchor), POSITIVE, np.uint8)
            yield record(anchor=anchor, key=packed_keys(anchor, values(batch, "score"), kind, values(batch, "id")))

    return positives.select("anchor", "score", "id").mapInArrow(run, "anchor long, key binary")


FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def windows_of_stream(
    keys: Iterator[tuple[int, int, int, int]], least: int, most: int, k: int
) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Negatives of each positive from keys in order. Held are the open windows of one anchor, nothing else."""
    at, open_ = None, []
    for anchor, score, kind, ident in keys:
        if anchor != at:
            at, open_ = anchor, []
        if kind == POSITIVE:
            open_.append([ident, score, 0])
            continue
        # A window ends when it is full or the stream has fallen below it.
        open_ = [w for w in open_ if w[2] < k and least * w[1] <= 100 * score]
        for window in open_:
            if 100 * score <= most * window[1]:
                window[2] += 1
                yield anchor, window[0], window[2], ident, window[1], score


def _stream(pairs: DataFrame, least: int, most: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def keys() -> Iterator[tuple[int, int, int, int]]:
            for batch in batches:
                yield from zip(*(part.tolist() for part in unpacked_keys(column(batch, "key"))))

        names = [field.split()[0] for field in FOUND.split(", ")]
        held: list[tuple[int, ...]] = []

        def made() -> pa.RecordBatch:
            out = [np.array(x, np.int32 if name == "rank" else np.int64) for name, x in zip(names, zip(*held))]
            return record(**dict(zip(names, out)))

        for row in windows_of_stream(keys(), least, most, k):
            held.append(row)
            if len(held) == 10_000:
                yield made()
                held.clear()
        if held:
            yield made()

    return pairs.repartition("anchor").sortWithinPartitions("key").mapInArrow(run, FOUND)


def _usable(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size(vector) > 0)


def hard_negatives(
    vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, least_share: int = LEAST_SHARE, most_share: int = MOST_SHARE,
    scale: float = SCALE, anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """For each row for which ``anchors`` holds and each of its positives the first negatives within the positive's window.

    Components become ``floor(scale * x)``, a score is the inner product of these with the anchor's, higher ones first, ties
    by the smaller id. Positives are the first rows of the anchor's label but itself; a negative has another label and
    a score of ``least_share`` to ``most_share`` hundredths of its positive's. A positive without negatives has no
    row. Scores are exact up to 2^56, about. Rows with a null id, label, vector or component, without
    components, with one that is not finite, or of another length than most, take no part. Of rows that share an
    id the one with the smallest label and vector counts. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    cells = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), cells.alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("asked"),
    )
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & _usable(F.col("vector")))
    empty = spark.createDataFrame([], FOUND)
    common = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return empty
    rows = rows.where(F.size("vector") == common["size"])
    one = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"), F.max("asked").alias("asked"))
    rows = stored(one.select("id", "row.label", "row.vector", "asked"), "vectors")
    asked = rows.where("asked")
    blocks = -(-asked.count() // anchor_block)
    found = empty
    for n in range(blocks):
        # One block of anchors at a time is with the driver: its size is bounded, whatever their number.
        taken = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == n).select("id", "label", "vector").toArrow().combine_chunks()
        if not taken.num_rows:
            continue
        ids, labels = taken.column("id").to_numpy(), taken.column("label").to_numpy()
        block = Anchors(ids, labels, _whole_numbers(taken.column("vector").combine_chunks(), scale))
        best = stored(_positives(rows, block, scale, positives), "positives")
        windows = _windows(best, ids, positives)
        pairs = _packed(best).union(_negatives(rows, Anchors(ids, labels, block.matrix, windows), scale, least_share, most_share, negatives))
        found = found.union(stored(_stream(pairs, least_share, most_share, negatives), "negatives"))
    return found


def _windows(best: DataFrame, ids: np.ndarray, positives: int) -> np.ndarray:
    """The scores of the positives of each anchor of a block. Where there are fewer the window is one that nothing fits."""
    scores = best.select("anchor", "place", "score").toArrow()
    out = np.full((len(ids), positives), -1, np.int64)
    order = np.argsort(ids)
    at = order[np.searchsorted(ids, scores.column("anchor").to_numpy(), sorter=order)]
    out[at, scores.column("place").to_numpy() - 1] = scores.column("score").to_numpy()
    return out
