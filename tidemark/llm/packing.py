"""Hierarchical packing of documents into sequences of several lengths.

A document longer than the longest tier gives whole windows; what is left goes to the smallest tier
that holds it. Tiers are packed from the longest down: the longest piece opens a window, and the
gap is filled with the pieces of shorter tiers that fit best. Where none fits, one is cut, so that
windows are full. Sequences of a tier are put into step groups of equal token budget and of nearly
equal attention cost.

A task packs pool after pool and hands what remains, less than the shortest tier, to the next pool.
The remains of many tasks are packed together at the end, so padding does not grow with the number
of tasks' pools.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import binaries, column, record, slices
from tidemark.llm.tokens import WORD_MODEL, encoder
from tidemark.session import stored

TIERS = (256, 512, 1024, 2048)
END_ID = 1
# Shorter pieces are not cut off on purpose.
LEAST_PIECE = 64
STEP_TOKENS = 16 * 2048
POOL_TOKENS = 2_000_000
# Tasks whose remains are packed together.
TOGETHER = 4096

Piece = tuple[int, int, int]  # document in the pool, first id, number of ids


class Shelf:
    """Pieces by length. The lengths in stock are the bits of one number."""

    def __init__(self, longest: int):
        self.by_length: list[list[Piece]] = [[] for _ in range(longest + 1)]
        self.stock, self.tokens = 0, 0

    def put(self, piece: Piece) -> None:
        if piece[2]:
            self.by_length[piece[2]].append(piece)
            self.stock |= 1 << piece[2]
            self.tokens += piece[2]

    def take(self, length: int) -> Piece:
        piece = self.by_length[length].pop()
        if not self.by_length[length]:
            self.stock ^= 1 << length
        self.tokens -= length
        return piece

    def largest(self, most: int) -> int:
        """The largest length in stock that is not above ``most``, or 0."""
        return max(0, (self.stock & ((2 << most) - 1)).bit_length() - 1)

    def smallest_above(self, length: int) -> int:
        above = self.stock >> (length + 1)
        return length + (above & -above).bit_length() if above else 0

    def cut(self, length: int, size: int) -> Piece:
        """The first ``size`` ids of a piece; the others stay."""
        doc, start, _ = self.take(length)
        self.put((doc, start + size, length - size))
        return doc, start, size


def fill(shelf: Shelf, gap: int) -> list[Piece]:
    """Pieces that fill a gap exactly; the shelf has at least as many ids."""
    window = []
    while gap:
        fit = shelf.largest(gap)
        if fit and (fit == gap or gap - fit >= LEAST_PIECE):
            window.append(shelf.take(fit))
        elif above := shelf.smallest_above(gap):
            window.append(shelf.cut(above, gap))
        else:
            window.append(shelf.take(fit))
        gap -= window[-1][2]
    return window


def pack(lengths: Sequence[int], tiers: Sequence[int] = TIERS) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Full windows (tier, pieces) over documents of these lengths, and the pieces that remain."""
    shelf, windows, longest = Shelf(tiers[-1]), [], tiers[-1]
    for doc, n in enumerate(map(int, lengths)):
        whole = n - n % longest
        windows += [(longest, [(doc, at, longest)]) for at in range(0, whole, longest)]
        shelf.put((doc, whole, n - whole))
    for tier, shorter in zip(tiers[::-1], [*tiers[-2::-1], 0]):
        while shelf.tokens >= tier and (length := shelf.largest(longest)) > shorter:
            if length > tier:
                windows.append((tier, [shelf.cut(length, tier)]))
            else:
                first = shelf.take(length)
                windows.append((tier, [first, *fill(shelf, tier - length)]))
    return windows, [p for pieces in shelf.by_length for p in pieces]


def step_groups(windows: list[tuple[int, list[Piece]]], step_tokens: int) -> list[int]:
    """A group for each window: one tier, ``step_tokens`` ids, and neighbours in attention cost."""
    cost = [sum(p[2] ** 2 for p in pieces) for _, pieces in windows]
    order = sorted(range(len(windows)), key=lambda i: (windows[i][0], cost[i]))
    groups, group, room, tier = [0] * len(windows), -1, 0, 0
    for i in order:
        if windows[i][0] != tier or room < windows[i][0]:
            group, room, tier = group + 1, step_tokens, windows[i][0]
        groups[i] = group
        room -= windows[i][0]
    return groups


class _Packer:
    """Packs the pools of one task."""

    def __init__(self, round_: int, tiers: Sequence[int], step_tokens: int):
        self.tiers, self.step_tokens = tiers, step_tokens
        task = TaskContext.get().partitionId()
        self.task, self.base = task, (round_ << 60) | (task << 36)
        self.sequences = self.steps = 0
        self.empty()

    def empty(self) -> None:
        # Per piece in the pool: id of the document, place in it, all its ids, and the ids.
        self.doc: list[int | None] = []
        self.start: list[int] = []
        self.whole: list[int] = []
        self.ids: list[np.ndarray] = []
        self.tokens = 0

    def add(self, doc: int | None, start: int, whole: int, ids: np.ndarray) -> None:
        self.doc.append(doc)
        self.start.append(start)
        self.whole.append(whole)
        self.ids.append(ids)
        self.tokens += len(ids)

    def _rows(self, windows: list[tuple[int, list[Piece]]], placed: bool) -> pa.RecordBatch:
        groups = step_groups(windows, self.step_tokens)
        order = sorted(range(len(windows)), key=groups.__getitem__)
        at, sequence, offset, tier, step, cost = [], [], [], [], [], []
        for n, i in enumerate(order):
            size = 0
            for piece in windows[i][1]:
                at.append(piece)
                sequence.append(self.base + self.sequences + n)
                offset.append(size)
                tier.append(windows[i][0])
                step.append(self.base + self.steps + groups[i])
                cost.append(sum(p[2] ** 2 for p in windows[i][1]))
                size += piece[2]
        if placed:
            self.sequences += len(windows)
            self.steps += max(groups, default=-1) + 1
        parts = [self.ids[d][s : s + n] for d, s, n in at]
        data = np.concatenate(parts).astype("<u4").view(np.uint8) if parts else np.zeros(0, np.uint8)
        size = np.array([n for _, _, n in at], np.int64)
        return record(
            doc=pa.array([self.doc[d] for d, _, _ in at], pa.int64()),
            start=np.array([self.start[d] + s for d, s, _ in at], np.int64), length=size,
            ids=binaries(data, np.cumsum(size) * 4), doc_tokens=np.array([self.whole[d] for d, _, _ in at], np.int64),
            sequence_id=np.array(sequence, np.int64), offset=np.array(offset, np.int64), tier=np.array(tier, np.int32),
            step_id=np.array(step, np.int64), cost=np.array(cost, np.int64),
            open_group=pa.array([None if placed else self.task // TOGETHER] * len(at), pa.int32()),
        )

    def flush(self) -> Iterator[pa.RecordBatch]:
        windows, rest = pack([len(x) for x in self.ids], self.tiers)
        for a in range(0, len(windows), 500):
            yield self._rows(windows[a : a + 500], True)
        kept = [(self.doc[d], self.start[d] + s, self.whole[d], self.ids[d][s : s + n].copy()) for d, s, n in rest]
        self.empty()
        for piece in kept:
            self.add(*piece)

    def remains(self, placed: bool) -> Iterator[pa.RecordBatch]:
        """What is left as one window, padded if ``placed``."""
        if self.doc:
            yield self._rows([(self.tiers[0], [(d, 0, len(x)) for d, x in enumerate(self.ids)])], placed)


_SCHEMA = (
    "doc long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, "
    "step_id long, cost long, open_group int"
)


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = WORD_MODEL,
    tiers: Sequence[int] = TIERS, step_tokens: int = STEP_TOKENS, end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit numbers),
    ``doc_tokens``, ``sequence_id``, ``offset``, ``tier``, ``step_id`` and the sequence's attention ``cost``.

    Every id of every document lies in one piece. Sequences are exactly as long as their tier, but
    for one per ``TOGETHER`` tasks. A null or empty text is the end id alone. Null and repeated
    document ids stay as they are: each row is a document. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(0, tiers, step_tokens)
        for batch in slices(batches, "text"):
            ids, counts = encoder(model).encode(column(batch, "text"))
            ends = np.cumsum(counts)
            for doc, a, b in zip(column(batch, "doc").to_pylist(), ends - counts, ends):
                packer.add(doc, 0, int(b - a) + 1, np.append(ids[a:b], np.uint32(end_id)))
                if packer.tokens >= POOL_TOKENS:
                    yield from packer.flush()
        yield from packer.flush()
        yield from packer.remains(False)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(1, tiers, step_tokens)
        for batch in batches:
            for r in batch.to_pylist():
                packer.add(r["doc"], r["start"], r["doc_tokens"], np.frombuffer(r["ids"], "<u4"))
                if packer.tokens >= POOL_TOKENS:
                    yield from packer.flush()
        yield from packer.flush()
        yield from packer.remains(True)

    made = stored(rows.mapInArrow(first, _SCHEMA), "packed")
    # In a fixed order, so that a task that runs again packs the same way.
    rest = made.where("open_group is not null").repartition("open_group")
    rest = rest.sortWithinPartitions("open_group", "sequence_id", "offset").mapInArrow(second, _SCHEMA)
    return made.where("open_group is null").unionByName(rest).select(F.col("doc").alias(id_col), *[
        "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_id", "cost",
    ])
