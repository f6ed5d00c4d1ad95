"""Lines that appear again, exactly or nearly, anywhere in the corpus.

Lines are compared by their character shingles: MinHash registers in bands find candidates, the
exact Jaccard similarity of the shingle sets decides, and union-find makes components. Of every
component the first line in order of document and place stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import hashing
from tidemark.llm.components import components
from tidemark.llm.frames import column, given_id, id_filter, in_filter, known_id, longs, map_slices, record, slices, sorted_blocks, spread, values
from tidemark.llm.probminhash import apart, band_hashes, bucket_links, links_across, meetings, packed_members, with_partners
from tidemark.session import discard, stored

# In letters, not bytes. One changed letter takes four strings from each set, which 36 different strings bear.
SHINGLE_LETTERS = 4
# A pair at the threshold shares a band with a probability of 0.995. Strings this short are shared by chance, so bands are
# of more rows: pairs of strangers that meet are about as many as with strings of eight bytes in bands of four.
BANDS, ROWS = 23, 7
THRESHOLD = 0.8
# A sketch has four bits of each of the first 64 registers. Similar pairs have 52 of them alike, with a standard deviation of
# 3.1; strangers four. Below 36, five deviations away, a pair is not looked at.
SKETCH_REGISTERS, SKETCH_LEAST = 64, 36
SKETCH = ["s0", "s1", "s2", "s3"]
# A rule of the stage, not of the classes: it leaves headings, bullets and closings below this in place.
STAY_BYTES = 40
LOOKS = 8
# Lines whose registers are made at once: what is worked on stays in the processor's cache.
BLOCK_LINES = 512
TEXT_PAIRS = 500
# Members of buckets that a task packs at once, and that are compared by sketches at once, about.
PACKED_MEMBERS, BLOCK_SKETCHES = 1 << 20, 20_000
# Buckets up to this are compared whole where their members meet, larger ones in blocks.
WHOLE_BUCKET = 256
_SHOWN, _INSIDE, _LARGE = range(3)
_SECOND_SEED = 0x5DEECE66D


def _lines(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lines in normal form that are not blank, the text and the place of each."""
    split = pc.split_pattern(pc.cast(column(batch, "lower"), pa.large_string()), "\n")
    size = np.asarray(pc.list_value_length(split))
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
    normal = pc.ascii_trim_whitespace(split.flatten())
    full = np.asarray(pc.binary_length(normal)) > 0
    return normal.filter(pa.array(full)), text[full], place[full]


def _key(lines: pa.Array, seed: int = 0) -> np.ndarray:
    data, begins = hashing.flat(lines)
    return longs(hashing.span_hashes(data, begins[:-1], begins[1:], seed))


def set_registers(elements: np.ndarray, owner: np.ndarray, owners: int, size: int) -> np.ndarray:
    """MinHash registers of sets, a row per owner, with one hash per element.

    An element goes to one register at random, and a register keeps the smallest hash. One that got none
    takes the hash of another one, in an order of its own; if that is empty as well some times, all elements are
    hashed for it. So any two sets agree in a register with the probability of their Jaccard similarity.
    Every owner has elements.
    """
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    drawn = hashing.mix(elements + np.uint64(0xD1B54A32D192ED03))
    slot = owner * size + ((drawn >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)).astype(np.int64)
    own = np.full(owners * size, none)
    np.minimum.at(own, slot, drawn * np.uint64(0x9E3779B97F4A7C15))
    won = own.copy()
    empty = np.flatnonzero(own == none)
    for turn in range(LOOKS):
        other = (hashing.mix(np.arange(size) + np.int64((turn + 1) << 32)) % np.uint64(size)).astype(np.int64)
        at = empty % size
        won[empty] = own[empty - at + other[at]]
        empty = empty[won[empty] == none]
    # Few elements would take very many looks.
    begins = np.searchsorted(empty, np.arange(owners + 1) * size)
    times = np.diff(begins)[owner]
    slot = empty[np.repeat(begins[owner] - np.cumsum(times) + times, times) + np.arange(times.sum())]
    drawn = np.repeat(hashing.mix(elements), times) + (slot % size + 1).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    np.minimum.at(won, slot, hashing.mix(drawn))
    return won.reshape(owners, size)


def _strings(letters: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all strings of ``size`` letters that do not run over a line's end, and the line of each."""
    n = max(0, len(letters) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += letters[k : k + n]
        # Behind the last letter too, so that each letter counts in the highest bits.
        out *= np.uint64(0x9E3779B97F4A7C15)
    count = np.maximum(np.diff(begins) - size + 1, 0)
    return out[spread(begins[:-1], count)], np.repeat(np.arange(len(count)), count)


def _shingles(lines: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all strings of ``size`` letters and the line of each. Letters are numbers made of their bytes."""
    data, begins = hashing.flat(lines)
    high = np.append(0, np.cumsum(data > 0x7F))
    wide = high[begins[1:]] > high[begins[:-1]]
    if not wide.any():
        return _strings(data, begins, size)
    # Lines of ASCII alone have a letter in each byte. In others every byte but those that go on with a letter starts one.
    made, line = _strings(*hashing.flat(lines.filter(pa.array(~wide))), size)
    data, begins = hashing.flat(lines.filter(pa.array(wide)))
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    length = np.diff(np.append(starts, len(data)))
    letters = data[starts].astype(np.uint64)
    for k in (1, 2, 3):
        longer = np.flatnonzero(length > k)
        letters[longer] |= data[starts[longer] + k].astype(np.uint64) << np.uint64(8 * k)
    more, at = _strings(letters, np.searchsorted(starts, begins), size)
    return np.concatenate([made, more]), np.concatenate([np.flatnonzero(~wide)[line], np.flatnonzero(wide)[at]])


def _occurrences(rows: DataFrame) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines, text, place = _lines(batch)
        return record(
            doc=values(batch, "doc")[text], body=values(batch, "body")[text], place=place.astype(np.int32),
            bytes=np.asarray(pc.binary_length(lines)).astype(np.int32), h1=_key(lines), h2=_key(lines, _SECOND_SEED),
        )

    return map_slices(rows.select("doc", "body", "lower"), "lower", work, "doc long, body long, place int, bytes int, h1 long, h2 long")


def _buckets(rows: DataFrame, shingle: int, bands: int, in_band: int) -> DataFrame:
    """Lines without a whole shingle are in no bucket: only their copies are like them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, ident, n = [], [], 0
        for batch in slices(batches, "lower"):
            lines = _lines(batch)[0].unique()
            lines = lines.filter(pc.greater_equal(pc.utf8_length(lines), shingle))
            for a in range(0, len(lines), BLOCK_LINES):
                block = lines.slice(a, BLOCK_LINES)
                made, line = _shingles(block, shingle)
                won = set_registers(made, line, len(block), bands * in_band)
                buckets.append(band_hashes(won, bands, in_band))
            ident.append(_key(lines))
            n += len(lines)
            if n * bands >= PACKED_MEMBERS:
                yield packed(buckets, ident)
                buckets, ident, n = [], [], 0
        if n:
            yield packed(buckets, ident)

    def packed(buckets: list[np.ndarray], ident: list[np.ndarray]) -> pa.RecordBatch:
        once, first = np.unique(np.concatenate(ident), return_index=True)
        return packed_members(np.concatenate(buckets)[first].ravel(), np.repeat(once, bands))

    return rows.select("lower").mapInArrow(run, "part int, members binary")


def sketches(won: np.ndarray) -> dict[str, np.ndarray]:
    """Four numbers per line, with four bits of each of the first registers."""
    bits = (won[:, :SKETCH_REGISTERS] & np.uint64(15)).reshape(len(won), len(SKETCH), -1)
    places = np.arange(bits.shape[2], dtype=np.uint64) * np.uint64(4)
    return dict(zip(SKETCH, longs((bits << places).sum(axis=2, dtype=np.uint64)).T))


def unlike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many registers differ between sketches, a row each."""
    apart = x ^ y
    for step in (1, 2):
        apart = apart | (apart >> np.uint64(step))
    return np.bitwise_count(apart & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)


def _line_texts(rows: DataFrame, members: DataFrame, shingle: int, bands: int, in_band: int) -> DataFrame:
    """The text and the sketch of lines that share a bucket, and of few others, once for each part of the input that has
    the line. They stay where they are read: joins go by sketches first, and few texts are needed after that."""
    shared = rows.sparkSession.sparkContext.broadcast(id_filter(members.select("id")))

    def texts(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        lines = _lines(batch)[0].unique()
        lines = lines.filter(pc.greater_equal(pc.utf8_length(lines), shingle))
        ident = _key(lines)
        keep = in_filter(shared.value, ident)
        lines, ident = lines.filter(pa.array(keep)), ident[keep]
        if not len(lines):
            return None
        parts = []
        for a in range(0, len(lines), BLOCK_LINES):
            block = lines.slice(a, BLOCK_LINES)
            made, line = _shingles(block, shingle)
            parts.append(sketches(set_registers(made, line, len(block), bands * in_band)))
        return record(id=ident, line=lines.cast(pa.string()), **{s: np.concatenate([p[s] for p in parts]) for s in SKETCH})

    schema = "id long, line string, " + ", ".join(f"{s} long" for s in SKETCH)
    return stored(map_slices(rows.select("lower"), "lower", texts, schema), "lines")


def _among(table: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``key`` is one of ``ids``, and few others. What is surely not among them is left out where it lies."""
    shared = table.sparkSession.sparkContext.broadcast(id_filter(ids))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = in_filter(shared.value, values(batch, key))
            if keep.any():
                yield batch.filter(pa.array(keep))

    return table.mapInArrow(pick, table.schema)


def _picked(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The lines of ``ids`` by id, and few others."""
    return _among(texts, "id", ids).dropDuplicates(["id"])


def pair_jaccards(x: pa.Array, y: pa.Array, size: int) -> np.ndarray:
    """Jaccard similarity of the sets of strings of ``size`` letters in the lines of each pair.

    A string is known by 53 bits of its hash, between the number of its pair and its side: sorting brings both sides together.
    """
    out = np.zeros(len(x))
    for a in range(0, len(x), 1000):
        n = len(x.slice(a, 1000))
        parts = []
        for side, lines in enumerate((x, y)):
            made, line = _shingles(lines.slice(a, 1000), size)
            parts.append((made >> np.uint64(11) << np.uint64(1)) | (line.astype(np.uint64) << np.uint64(54)) | np.uint64(side))
        both = np.sort(np.concatenate(parts))
        both = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
        again = both[1:][(both[1:] ^ both[:-1]) == np.uint64(1)]
        shared = np.bincount((again >> np.uint64(54)).astype(np.int64), minlength=n)
        total = np.bincount((both >> np.uint64(54)).astype(np.int64), minlength=n) - shared
        out[a : a + n] = shared / np.maximum(total, 1)
    return out


def _near(members: DataFrame, narrow: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` in a bucket whose sketches are alike enough, by ``kind``: first those of a member with the bucket's leader
    or with the one before, then others of buckets up to ``WHOLE_BUCKET``. Of larger buckets the last kind has bucket and member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in sorted_blocks(batches, "bucket", BLOCK_SKETCHES, lambda _: False):
            bucket, ident = block.column("bucket").to_numpy(), block.column("id").to_numpy()
            order = np.lexsort((ident, bucket))
            order = order[np.append(True, (np.diff(bucket[order]) != 0) | (np.diff(ident[order]) != 0))]
            bucket, ident = bucket[order], ident[order]
            sketch = np.stack([block.column(s).to_numpy()[order] for s in SKETCH], axis=1).view(np.uint64)
            start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            size = np.diff(np.append(start, len(bucket)))
            head, size = np.repeat(start, size), np.repeat(size, size)
            place = np.arange(len(bucket)) - head

            def pairs(i: np.ndarray, j: np.ndarray, kind: int) -> pa.RecordBatch:
                keep = unlike(sketch[i], sketch[j]) <= SKETCH_REGISTERS - SKETCH_LEAST
                return record(a=ident[i[keep]], b=ident[j[keep]], kind=np.full(keep.sum(), kind, np.int8))

            j = np.flatnonzero(place > 0)
            yield pairs(head[j], j, _SHOWN)
            j = j[place[j] > 1]
            yield pairs(j - 1, j, _SHOWN)
            i = np.flatnonzero((place > 0) & (size <= WHOLE_BUCKET))
            for step in range(2, WHOLE_BUCKET):
                i = i[place[i] + step < size[i]]
                if not len(i):
                    break
                yield pairs(i, i + step, _INSIDE)
            large = size > WHOLE_BUCKET
            yield record(a=bucket[large], b=ident[large], kind=np.full(large.sum(), _LARGE, np.int8))

    ordered = members.select("bucket", "id").join(narrow, "id").repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(run, "a long, b long, kind tinyint")


def _similar(near: DataFrame, texts: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """The pairs that are similar enough by the text of their lines."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pair_jaccards(column(batch, "x"), column(batch, "y"), shingle) >= threshold
            yield record(a=values(batch, "a")[keep], b=values(batch, "b")[keep])

    lines = _picked(texts.select("id", "line"), near.select(F.col("a").alias("id")).union(near.select("b")))
    joined = near.join(lines.select(F.col("id").alias("a"), F.col("line").alias("x")), "a")
    joined = joined.join(lines.select(F.col("id").alias("b"), F.col("line").alias("y")), "b")
    return joined.mapInArrow(verify, "a long, b long")


def _across(
    members: DataFrame, label: DataFrame, narrow: DataFrame, texts: DataFrame, shingle: int, threshold: float
) -> tuple[DataFrame, DataFrame]:
    """Links that leaders and chains of the buckets have not shown, and a stored table behind them."""

    def near_in(block: pa.Table) -> Callable:
        sketch = np.stack([block.column(s).to_numpy() for s in SKETCH], axis=1).view(np.uint64)
        return lambda i, j: unlike(sketch[i], sketch[j]) <= SKETCH_REGISTERS - SKETCH_LEAST

    def judge(block: pa.Table) -> tuple[Callable, Callable]:
        lines = block.column("line").combine_chunks()

        def alike(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            keep = np.zeros(len(i), bool)
            # The texts of few pairs at a time: a line is copied for each pair it is in.
            for a in range(0, len(i), TEXT_PAIRS):
                x, y = (lines.take(pa.array(k[a : a + TEXT_PAIRS])) for k in (i, j))
                keep[a : a + TEXT_PAIRS] = pair_jaccards(x, y, shingle) >= threshold
            return keep

        return near_in(block), alike

    # Members meet by their sketches; only those with a partner meet again with their texts.
    paired = stored(with_partners(meetings(members, label).join(narrow, "id"), near_in), "paired")
    lines = _picked(texts, paired.select("id"))
    return links_across(paired.join(lines, "id"), judge), paired


def line_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_LETTERS,
    threshold: float = THRESHOLD, bands: int = BANDS, in_band: int = ROWS,
) -> DataFrame:
    """One row per line that is not blank: ``doc``, ``body``, ``place``, its length in ``bytes``, and the line that
    stays: ``first_doc``, ``first_body``, ``first_place``.

    ``doc`` is the id, or the largest long for null; ``body`` tells apart rows that share an id.
    Lines are compared in lower case, without white space at their ends. Lines that share a bucket are
    compared with its first line and with the one before; those of different components then with each other.
    Copies are one class at any length; lines too short for a shingle are compared in no other way.
    """
    rows = docs.select(known_id(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).cast("string").alias("text"))
    rows = rows.select("doc", F.xxhash64("text").alias("body"), F.lower("text").alias("lower"))
    members = stored(bucket_links(_buckets(rows, shingle, bands, in_band)), "buckets")
    texts = _line_texts(rows, members, shingle, bands, in_band)
    narrow = stored(texts.select("id", *SKETCH).dropDuplicates(["id"]), "sketches")
    met = stored(_near(members, narrow), "near")
    near = stored(met.where(F.col("kind") == _SHOWN).select("a", "b").distinct(), "near")
    links = stored(_similar(near, texts, shingle, threshold), "links")
    label = components(links)
    inside = stored(apart(met.where(F.col("kind") == _INSIDE).select("a", "b").distinct(), label), "near")
    more = stored(_similar(inside, texts, shingle, threshold), "links")
    large = met.where(F.col("kind") == _LARGE).select(F.col("a").alias("bucket"), F.col("b").alias("id"))
    across, paired = _across(large, label, narrow, texts, shingle, threshold)
    rest = stored(across, "links")
    label = components(links.union(more).union(rest))
    for table in (members, texts, narrow, met, near, links, inside, more, paired, rest):
        discard(table)
    lines = stored(_occurrences(rows), "occurrences")
    # Copies first: one row per distinct line, then one per component.
    copies = lines.groupBy("h1", "h2").agg(
        F.min(F.struct("doc", "place", "body")).alias("first"), F.min("bytes").alias("bytes"), F.count("*").alias("times")
    )
    nodes = label.select(F.col("node").alias("h1"), "root").union(label.select("root", "root").distinct())
    named = stored(copies.join(nodes, "h1", "left"), "named")
    # A line that is there once and like no other one has no other place to be told of.
    once, again = named.where("root IS NULL AND times = 1"), named.where("root IS NOT NULL OR times > 1")
    alone, united = again.where("root IS NULL"), again.where("root IS NOT NULL")
    heads = united.groupBy("root").agg(F.min("first").alias("head"))
    named = united.join(heads, "root").select("h1", "h2", "head").union(alone.select("h1", "h2", "first"))
    found = _among(lines, "h1", again.select("h1")).join(named, ["h1", "h2"])
    places = ["doc", "body", "place"]
    columns = [*places, "bytes", *(F.col(f"head.{c}").alias(f"first_{c}") for c in places)]
    once = once.select(*(F.col(f"first.{c}") for c in places), "bytes", F.col("first").alias("head"))
    return found.select(*columns).union(once.select(*columns))


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stay_bytes: int = STAY_BYTES, **options
) -> DataFrame:
    """``docs`` with all columns, each line of a component taken out but the first one.

    Lines shorter than ``stay_bytes`` stay, repeated or not: headings, bullets and closings repeat by nature, and a
    text without them reads worse. ``stay_bytes=0`` takes them out too. A document that loses lines and
    keeps nothing but white space goes; others stay, also empty or null ones. Rows that repeat an
    id and text are the same line: all of them keep it.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    gone = line_classes(docs, id_col, text_col, **options).where(F.col("bytes") >= stay_bytes).where(
        ~((F.col("doc") == F.col("first_doc")) & (F.col("body") == F.col("first_body")) & (F.col("place") == F.col("first_place")))
    )
    gone = gone.groupBy("doc", "body").agg(F.collect_set("place").alias("gone"))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), known_id(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("body")
    )
    joined = keyed.join(gone, ["doc", "body"], "left")
    whole = F.split(F.col("_row").getField(text_col), "\n", -1)
    kept = F.array_join(F.filter(whole, lambda line, i: ~F.array_contains(F.col("gone"), i)), "\n")
    text_now = F.when(F.col("gone").isNull(), F.col("_row").getField(text_col)).otherwise(kept)
    columns = [text_now.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns]
    return joined.where(F.col("gone").isNull() | kept.rlike(r"\S")).select(*columns)
