"""Where windows of words or bytes recur in other documents, and what is left without the later copies.

A window (13 words, 50 bytes) is found again in four steps, none of which looks at pairs of documents:

1. Every window is represented by its *anchor*, the smallest hash of the short shingles in it.
   Neighbouring windows share anchors, so a document sends one row per handful of windows.
   Equal windows have equal anchors, so nothing is lost.
2. Rows are grouped by anchor. Anchors of a single document are dropped.
3. Documents get back their anchors that recur, and send the *passages* whose windows have such
   an anchor to the anchor's task. Anchors that very many documents share are hot: their windows
   are sent one by one, by the hash of the window, so they spread over many tasks.
4. A task takes the passages in blocks of bounded size, locates every window exactly, and compares
   the document of each occurrence with the smallest that has the window.

Copies of a whole text take no part in this: all but those with the smallest id lose every window,
and a text is looked up once. Texts are told apart by 128 bits, so ids may be null or repeat. Rows name a text
by its smallest id, which shuffles better than a hash; texts that share that id are named by 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import hashing
from tidemark.llm.frames import binaries, column, content_key, known_id, longs, map_packed, packed, record, sorted_blocks, spread, values
from tidemark.session import stored

# An anchor of more documents than this is hot.
HOT_DOCUMENTS = 20_000
BLOCK_ROWS = 20_000
# Anchors have 48 bits, the lowest of them free: they choose candidates only, and small numbers shuffle better.
_ANCHOR_BITS = np.uint64((1 << 48) - 2)

# Gets distinct passages, the smallest document of each, and whether others have it too. For every window that recurs
# among them: index of the passage, place in it, and smallest document that has the window.
Locate = Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Windows:
    """Windows of ``length`` words or bytes, found by shingles of ``anchor`` words or bytes."""

    length: int
    anchor: int
    of_words: bool

    def units(self, texts: pa.Array) -> Units:
        data, begins = hashing.flat(texts)
        if not self.of_words:
            return Units(data, begins, None, None, hashing.byte_shingles(data, self.anchor))
        starts, ends, first = hashing.word_spans(data, begins)
        hashes = hashing.shingles(hashing.span_hashes(data, starts, ends), self.anchor)
        return Units(data, first, starts, ends, hashes)

    def anchors(self, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Neighbouring windows of a text that share an anchor: the anchor, the text, the place of the first, their number."""
        smallest = hashing.sliding_min(units.shingles & _ANCHOR_BITS, self.length - self.anchor + 1)
        # Windows from the last places of a text would run over its end.
        begins, over = units.first[:-1], np.maximum(units.first[1:] - self.length + 1, units.first[:-1])
        new = np.ones(len(smallest), bool)
        new[1:] = smallest[1:] != smallest[:-1]
        new[begins[begins < len(new)]] = True
        new[over[over < len(new)]] = True
        place = np.flatnonzero(new)
        size = np.diff(np.append(place, len(new)))
        text = np.searchsorted(units.first, place, "right") - 1
        inside = place < over[text]
        place, size = place[inside], size[inside]
        return smallest[place], text[inside], place, size


@dataclass(frozen=True)
class Units:
    """Words or bytes of many texts: ``first`` is the index of each text's first one."""

    data: np.ndarray
    first: np.ndarray
    starts: np.ndarray | None
    ends: np.ndarray | None
    shingles: np.ndarray

    def cut(self, at: np.ndarray, size: np.ndarray) -> pa.Array:
        """The ``size`` units from each of the places ``at``."""
        if self.starts is None:
            return binaries(self.data[spread(at, size)], np.cumsum(size))
        # Words of a passage are joined by one space, so that equal windows are equal bytes.
        words = ((self.starts[a : a + n], self.ends[a : a + n]) for a, n in zip(at, size))
        return pa.array([b" ".join(self.data[a:b].tobytes() for a, b in zip(*w)) for w in words], pa.binary())


def _changes(*arrays: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.ones(len(arrays[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([a[1:] != a[:-1] for a in arrays])
    return np.flatnonzero(new)


def _anchor_rows(docs: DataFrame, windows: Windows) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        anchor, text, _, _ = windows.anchors(windows.units(column(batch, "text")))
        who = values(batch, "who")[text]
        order = np.lexsort((who, anchor))
        anchor, who = anchor[order], who[order]
        keep = _changes(anchor, who)
        return record(who=who[keep], anchor=longs(anchor[keep]))

    return map_packed(docs.select("who", "text"), "text", work, "who long, anchor long")


def _recurring(rows: DataFrame, hot_documents: int) -> DataFrame:
    """Rows whose anchor more than one text has. The lowest bit of the anchor says that it is hot."""

    def flagged(anchor: np.ndarray, who: np.ndarray, hot: bool | None = None) -> pa.RecordBatch:
        starts = _changes(anchor)
        sizes = np.diff(np.append(starts, len(anchor)))
        if hot is None:
            lone = np.minimum.reduceat(who, starts) == np.maximum.reduceat(who, starts)
            bit = (sizes > hot_documents).astype(np.int64)
        else:
            lone, bit = np.zeros(len(starts), bool), np.ones(len(starts), np.int64)
        keep = ~np.repeat(lone, sizes)
        return record(anchor=(anchor | np.repeat(bit, sizes))[keep], who=who[keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        going_on = None
        for block, open_ in sorted_blocks(batches, "anchor", max(BLOCK_ROWS, hot_documents + 1)):
            anchor, who = block.column("anchor").to_numpy(), block.column("who").to_numpy()
            if going_on is not None:
                # The key of the block before goes on; it was cut because it is hot.
                more = int(np.searchsorted(anchor, going_on, "right"))
                if more:
                    yield flagged(anchor[:more], who[:more], True)
                anchor, who = anchor[more:], who[more:]
                if not len(anchor):
                    continue
            if open_:
                yield flagged(anchor, who, True)
            elif len(anchor):
                yield flagged(anchor, who)
            going_on = anchor[-1] if open_ else None

    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "anchor long, who long")


def _passages(joined: DataFrame, windows: Windows) -> DataFrame:
    """The passages around recurring anchors: key of the task, row, place of the first unit, bytes."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        units = windows.units(column(batch, "text"))
        anchor, text, at, size = windows.anchors(units)
        listed = column(batch, "anchors")
        hits = listed.flatten().to_numpy().view(np.uint64)
        if not len(hits) or not len(anchor):
            return None
        # Text and anchor are looked up as one number.
        owner = np.repeat(np.arange(len(listed)), np.asarray(pc.list_value_length(listed).fill_null(0)))
        known, code = np.unique(hits & ~np.uint64(1), return_inverse=True)
        own = owner * len(known) + code
        order = np.lexsort((hits, own))
        own, hits = own[order], hits[order]
        code = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
        mine = text * len(known) + code
        found = np.minimum(np.searchsorted(own, mine), len(own) - 1)
        keep = np.flatnonzero((known[code] == anchor) & (own[found] == mine))
        if not len(keep):
            return None
        keys, at, size, which = hits[found[keep]], at[keep], size[keep], text[keep]
        # Windows of a hot anchor are passages of their own.
        times = np.where(keys & np.uint64(1), size, 1)
        at, size = spread(at, times), np.repeat(np.where(keys & np.uint64(1), 1, size), times)
        keys, which = np.repeat(keys, times), np.repeat(which, times)
        passages = units.cut(at, size + windows.length - 1)
        hot = np.flatnonzero(keys & np.uint64(1))
        if len(hot):
            data, begins = hashing.flat(passages.take(pa.array(hot)))
            keys[hot] = hashing.span_hashes(data, begins[:-1], begins[1:]) | np.uint64(1)
        return record(
            key=longs(keys), doc=values(batch, "doc")[which], who=values(batch, "who")[which],
            at=(at - units.first[which]).astype(np.int32), passage=passages,
        )

    return map_packed(joined, "text", work, "key long, doc long, who long, at int, passage binary")


def _removed(passages: DataFrame, windows: Windows, locate: Locate) -> DataFrame:
    """Runs of units that a window of an earlier document covers, by text."""

    def spans(block: pa.Table, earlier: dict[bytes, int]) -> tuple[pa.RecordBatch | None, dict[bytes, int]]:
        coded = block.column("passage").combine_chunks().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        texts, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        doc = block.column("doc").to_numpy()
        first = np.full(len(texts), np.iinfo(np.int64).max)
        np.minimum.at(first, code, doc)
        for i, text in enumerate(texts if earlier else ()):
            first[i] = min(first[i], earlier.get(text, first[i]))
        several = np.zeros(len(texts), bool)
        several[code[doc > first[code]]] = True
        last_key = block.column("key")[-1].as_py()
        same = block.column("key").to_numpy() == last_key
        known = {texts[i]: int(first[i]) for i in np.unique(code[same])} if last_key & 1 else {}
        which, place, least = locate(texts, first, several)
        if not len(which):
            return None, known
        # Windows of each distinct passage, then of each occurrence of it.
        order = np.lexsort((place, which))
        which, place, least = which[order], place[order], least[order]
        lo, hi = np.searchsorted(which, code), np.searchsorted(which, code, "right")
        count = hi - lo
        row = np.repeat(np.arange(len(code)), count)
        entry = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        late = least[entry] < doc[row]
        row, where = row[late], place[entry][late].astype(np.int64)
        if not len(row):
            return None, known
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (where[1:] > where[:-1] + windows.length)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(row)) - 1
        row_of = row[begin]
        made = record(
            who=block.column("who").to_numpy()[row_of],
            at=(block.column("at").to_numpy()[row_of] + where[begin]).astype(np.int32),
            size=(where[end] - where[begin] + windows.length).astype(np.int32),
        )
        return made, known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        earlier: dict[bytes, int] = {}
        for block, _ in sorted_blocks(batches, "key", BLOCK_ROWS, lambda key: bool(key & 1)):
            made, earlier = spans(block, earlier)
            if made is not None:
                yield made

    # In order of document within a key, so that a hot window's first document comes first.
    ordered = passages.repartition("key").sortWithinPartitions("key", "doc")
    return ordered.mapInArrow(run, "who long, at int, size int")


def without_later_copies(
    docs: DataFrame, windows: Windows, locate: Locate, id_col: str = "doc_id", text_col: str = "text",
    hot_documents: int = HOT_DOCUMENTS,
) -> DataFrame:
    """Per row: id, ``n_units``, ``n_removed``, ``n_spans`` and ``kept`` (binary).

    A unit goes if a window over it also begins in a document with a smaller id. Null texts have
    no units; a null id counts as larger than any; rows with one id never remove from each other.
    Texts shorter than a window stay whole. Other columns of ``docs`` are not looked at.
    """
    rows = docs.select(known_id(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).cast("string").alias("text"))
    rows = rows.select("doc", "text", *content_key(F.col("text")))
    firsts = rows.groupBy("k1", "k2").agg(F.min("doc").alias("first"))
    several = firsts.groupBy("first").agg(F.count("*").alias("n")).where("n > 1")
    # Read from here on; so the texts are hashed for it once.
    firsts = stored(firsts.join(several, "first", "left").select("k1", "k2", "first", F.expr("if(n IS NULL, first, k1)").alias("who")), "firsts")
    # All hold; said here, so that the joins below do not differ in what they ask of these rows.
    rows = packed(rows, "text").where("doc IS NOT NULL AND k1 IS NOT NULL AND k2 IS NOT NULL")
    # These joins deal the rows out by the same keys, so that Spark shuffles the texts once. No id is below
    # the first; an equality would make the id a third key.
    texts = rows.join(firsts, ["k1", "k2"]).where("doc <= first").select("who", "text")
    hits = _recurring(_anchor_rows(texts, windows), hot_documents).groupBy("who").agg(F.collect_set("anchor").alias("anchors"))
    own = rows.join(firsts.join(hits, "who"), ["k1", "k2"]).where("doc <= first").select("doc", "text", "who", "anchors")
    spans = _removed(_passages(own, windows), windows, locate)
    spans = spans.groupBy("who").agg(F.collect_set(F.struct("at", "size")).alias("spans"))

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, begins = hashing.flat(column(batch, "text"))
        if windows.of_words:
            starts, ends, first = hashing.word_spans(data, begins)
        else:
            first = begins
        drop = np.zeros(first[-1] + 1, np.int32)
        listed = column(batch, "spans")
        inner = listed.flatten()
        lengths = np.asarray(pc.list_value_length(listed).fill_null(0))
        owner = np.repeat(np.arange(len(lengths)), lengths)
        at = inner.field("at").to_numpy() + first[owner]
        np.add.at(drop, at, 1)
        np.add.at(drop, at + inner.field("size").to_numpy(), -1)
        # A copy of an earlier text loses every window.
        copies = np.flatnonzero((values(batch, "doc") > values(batch, "first")) & (np.diff(first) >= windows.length))
        np.add.at(drop, first[copies], 1)
        np.add.at(drop, first[copies + 1], -1)
        gone = np.cumsum(drop)[:-1] > 0
        new_run = gone.copy()
        new_run[1:] &= ~gone[:-1]
        heads = first[:-1][first[:-1] < len(gone)]
        new_run[heads] = gone[heads]
        total = lambda x: np.diff(np.append(0, np.cumsum(x))[first])
        if windows.of_words:
            kept = []
            for i in range(batch.num_rows):
                live = np.flatnonzero(~gone[first[i] : first[i + 1]]) + first[i]
                kept.append(b" ".join(data[a:b].tobytes() for a, b in zip(starts[live], ends[live])))
            kept = pa.array(kept, pa.binary())
        else:
            kept = binaries(data[~gone], np.cumsum(total(~gone)))
        return record(
            doc=column(batch, "doc"), n_units=np.diff(first), n_removed=total(gone).astype(np.int64),
            n_spans=total(new_run).astype(np.int64), kept=kept,
        )

    joined = rows.join(firsts.join(spans, "who", "left"), ["k1", "k2"]).select("doc", "text", "first", "spans")
    schema = "doc long, n_units long, n_removed long, n_spans long, kept binary"
    return map_packed(joined, "text", finish, schema)
