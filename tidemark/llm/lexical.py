"""Ranked search without an index: an automaton of all item terms reads the documents and counts.

Items are a stated set of queries. Their terms, each between two guards, make one Aho-Corasick automaton; a document in
which every separator is a guard is run through it, so a hit is a whole term and its end a separator. The automaton's
outputs are numbers of terms, and these lead to the items. A document leaves the scan as its terms and counts; with the
counts of the corpus known, tasks score these and keep the best documents of each item.

The automaton is of bounded size: items are taken in blocks, and the documents are read once per block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm import hashing
from tidemark.llm.frames import column, map_slices, record, values
from tidemark.session import discard, stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 20
# Bytes of item terms in one automaton.
BLOCK_BYTES = 2_000_000
# Bytes of text that are run through the automaton at once, and cells of a matrix of scores.
RUN_BYTES = 1 << 20
CELLS = 1 << 21
GATHERED = 1 << 18
GUARD = 32
MAX = np.iinfo(np.int64).max

# Letters and digits of ASCII, capitals as small ones, and every byte of other letters; all else is a guard.
_TERM_BYTE = np.full(256, GUARD, np.uint8)
for _range in (range(48, 58), range(97, 123), range(128, 256)):
    _TERM_BYTE[list(_range)] = list(_range)
_TERM_BYTE[65:91] = range(97, 123)


@dataclass(frozen=True)
class Items:
    """A block of items: their terms, and for each term the items that have it and how often.

    The items of term ``t`` are at ``first[t]`` to ``first[t + 1]`` of ``item`` and ``times``.
    """

    ids: list[int | None]
    terms: list[str]
    first: np.ndarray
    item: np.ndarray
    times: np.ndarray

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for n, term in enumerate(self.terms):
            made.add_word(f" {term} ", n)
        if self.terms:
            made.make_automaton()
        return made


def terms_of(data: np.ndarray) -> list[str]:
    """The terms of one text, a letter for each byte."""
    return _TERM_BYTE[data].tobytes().decode("latin-1").split()


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[Items]:
    """The items, one block at a time: only one is with the driver."""
    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for block in range(blocks):
        counts: dict[str, dict[int, int]] = {}
        ids: dict[int | None, int] = {}
        taken = rows.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).orderBy("id").collect() if blocks > 1 else rows.orderBy("id").collect()
        for row in taken:
            at = ids.setdefault(row["id"], len(ids))
            for term in terms_of(np.frombuffer(row["text"].encode(), np.uint8)):
                per_item = counts.setdefault(term, {})
                per_item[at] = per_item.get(at, 0) + 1
        terms = sorted(counts)
        pairs = [pair for t in terms for pair in counts[t].items()]
        first = np.append(0, np.cumsum([len(counts[t]) for t in terms], dtype=np.int64))
        item, times = np.array(pairs, np.int64).reshape(-1, 2).T
        yield Items(list(ids), terms, first, item, times)


def windows(data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Parts of about ``size`` bytes that begin and end beside a guard, so that no term is cut."""
    at = 0
    while at < len(data):
        to = min(at + size, len(data))
        while to < len(data):
            behind = np.flatnonzero(data[to : to + size] == GUARD)
            if len(behind):
                to += int(behind[0]) + 1
                break
            to = min(to + size, len(data))
        yield at, to
        at = to


def _counts(docs: DataFrame, items: Items) -> DataFrame:
    """Documents with terms: ``doc``, the number ``n`` of their terms, the item terms in them and how often."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    automata: list[ahocorasick.Automaton] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not automata:
            automata.append(shared.value.automaton())
        raw, begins = hashing.flat(column(batch, "text"))
        # A guard before, between and behind the texts.
        data = np.full(len(raw) + batch.num_rows + 1, GUARD, np.uint8)
        text = np.repeat(np.arange(batch.num_rows), np.diff(begins))
        data[np.arange(len(raw)) + text + 1] = _TERM_BYTE[raw]
        starts = begins + np.arange(len(begins))
        solid = data != GUARD
        heads = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
        n = np.diff(np.searchsorted(heads, starts))
        keys = []
        if len(automata[0]):
            for a, b in windows(data, RUN_BYTES):
                # The guard before a window is that which ends the one before.
                part = data[max(0, a - 1) : b].tobytes().decode("latin-1")
                hits = np.fromiter(chain.from_iterable(automata[0].iter(part)), np.int64).reshape(-1, 2)
                owner = np.searchsorted(starts, hits[:, 0] + max(0, a - 1) - 1, "right") - 1
                keys.append(np.unique(owner * len(shared.value.terms) + hits[:, 1], return_counts=True))
        key = np.concatenate([k for k, _ in keys]) if keys else np.zeros(0, np.int64)
        count = np.concatenate([c for _, c in keys]) if keys else key
        if len(keys) > 1:
            key, back = np.unique(key, return_inverse=True)
            count = np.bincount(back, count, len(key)).astype(np.int64)
        owner, term = np.divmod(key, max(1, len(shared.value.terms)))
        cut = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        full = np.flatnonzero(n)
        if not len(full):
            return None
        term, count = term.astype(np.int32), count.astype(np.int64)
        return record(
            doc=column(batch, "doc").take(pa.array(full)), n=n[full].astype(np.int64),
            terms=pa.array([term[cut[i] : cut[i + 1]].tobytes() for i in full], pa.binary()),
            counts=pa.array([_narrow(count[cut[i] : cut[i + 1]]) for i in full], pa.binary()),
        )

    return map_slices(docs, "text", work, "doc long, n long, terms binary, counts binary")


def _narrow(counts: np.ndarray) -> bytes:
    """Counts as 16 bits each; where one needs more, all as 64 behind a byte that makes the length odd."""
    if counts.max(initial=0) < 1 << 16:
        return counts.astype(np.uint16).tobytes()
    return b"w" + counts.tobytes()


def _wide(counts: bytes) -> np.ndarray:
    if len(counts) % 2:
        return np.frombuffer(counts, np.int64, offset=1)
    return np.frombuffer(counts, np.uint16).astype(np.int64)


def _document_frequencies(counts: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each term of a block is: a sum of what tasks count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(terms, np.int64)
        for batch in batches:
            for x in column(batch, "terms"):
                found[np.frombuffer(x.as_buffer(), np.int32)] += 1
        at = np.flatnonzero(found)
        yield record(term=at, df=found[at])

    made = counts.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(terms, np.int64)
    out[made.column("term").to_numpy()] = made.column("df").to_numpy()
    return out


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _summed(key: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers, exact: doubles hold the halves."""
    low = np.bincount(key, value & ((1 << 26) - 1), size).astype(np.int64)
    return low + (np.bincount(key, value >> 26, size).astype(np.int64) << 26)


class _Best:
    """The ``k`` best documents of each item by falling score, then id."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """``scores`` has a row per document."""
        doc, item = np.nonzero(scores >= self.least)
        self.parts.append((item, scores[doc, item], docs[doc]))
        self.size += len(doc)
        if self.size > max(GATHERED, 2 * self.k * len(self.least)):
            self.keep()

    def keep(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        item, score, doc = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item, "left")
        last = place == self.k - 1
        self.least[item[last]] = score[last]
        first = place < self.k
        self.parts = [(item[first], score[first], doc[first])]
        self.size = int(first.sum())
        return self.parts[0]


def _ranked(counts: DataFrame, items: Items, weights: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    """The best documents of each item in each task."""
    shared = counts.sparkSession.sparkContext.broadcast((items, weights))
    n_items = len(items.ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = shared.value
        fan = np.diff(block.first)
        best = _Best(n_items, k)
        step = max(1, CELLS // max(1, n_items))
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                term = [np.frombuffer(x.as_buffer(), np.int32) for x in column(part, "terms")]
                row = np.repeat(np.arange(part.num_rows), [len(x) for x in term])
                term = np.concatenate(term).astype(np.int64)
                tf = np.concatenate([_wide(x.as_py()) for x in column(part, "counts")])
                m = 75 + (25 * values(part, "n") * documents) // length
                share = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
                # Each count goes to every item with the term.
                times = fan[term]
                at = np.arange(times.sum()) + np.repeat(block.first[term] - (np.cumsum(times) - times), times)
                key = np.repeat(row, times) * n_items + block.item[at]
                scores = _summed(key, np.repeat(share, times) * block.times[at], part.num_rows * n_items)
                ids = column(part, "doc").fill_null(MAX).to_numpy()
                best.add(scores.reshape(part.num_rows, n_items), ids)
        item, score, doc = best.keep()
        if len(item):
            yield record(item=item, score=score, doc=doc)

    return counts.mapInArrow(run, "item long, score long, doc long")


def _first(found: DataFrame, k: int, *group: str | Column) -> DataFrame:
    order = F.row_number().over(W.partitionBy(*group).orderBy(F.desc("score"), "doc"))
    return found.withColumn("rank", order).where(F.col("rank") <= k)


def ranked_documents(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", k: int = TOP, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 of each item: ``item_id``, ``rank``, the document's id, ``score``.

    Terms are runs of letters and digits of ASCII, A to Z as small ones, and of any other character that is not ASCII.
    ``N`` documents have a term, ``L`` terms all told; a document has ``n`` terms, ``tf`` of them one term, which ``df``
    documents hold. A term weighs ``w = floor(1000 ln((2N + 2) / (2df + 1)))``, and with ``m = 75 + 25nN div L`` a score is
    the sum of ``w (10^9 tf div (1000 tf + 12m))`` over the terms of the item, repeats included. All but the logarithm
    is whole numbers. Equal scores go by rising id, null ids last. Every row is a document of its own, also if
    rows repeat. Equal rows of items count once; different texts of one item id, null among them, are one item.
    Null and empty texts have no terms. Other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    ids = spark.createDataFrame([], "item_id long, rank int, doc long, score long")
    for block in item_blocks(items, item_id_col, item_text_col, block_bytes):
        if not block.terms:
            continue
        counts = stored(_counts(rows, block), "counts")
        documents, length = counts.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            continue
        df = _document_frequencies(counts, len(block.terms))
        weights = np.array([term_weight(documents, int(x)) for x in df], np.int64)
        found = _ranked(counts, block, weights, documents, length, k)
        # Tasks are many at scale, so their answers are ranked in groups first.
        found = _first(found.withColumn("group", F.pmod(F.xxhash64("doc"), F.lit(64))), k, "item", "group").drop("group", "rank")
        names = spark.createDataFrame([(n, i) for n, i in enumerate(block.ids)], "item long, item_id long")
        best = _first(found, k, "item").join(F.broadcast(names), "item")
        ids = ids.union(stored(best.select("item_id", "rank", "doc", "score"), "ranked"))
        discard(counts)
    return ids.select("item_id", "rank", F.when(F.col("doc") != MAX, F.col("doc")).alias(id_col), "score")
