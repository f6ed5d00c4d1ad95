"""Near duplicates by ProbMinHash: probability Jaccard similarity of weighted word shingles.

Every shingle of a document starts a Poisson process with its weight as rate. An arrival picks a
register at random, and a register keeps the shingle whose arrival came first. Two documents agree
in a register with the probability Jaccard similarity of their weighted shingles. A shingle's
process is a function of the shingle alone and ends once it is later than every register.

Registers are banded. A bucket sends each member with the bucket's first one and with the one
before, never all pairs. These candidates are verified exactly and united. Members of larger buckets
that are not united by then are compared with each other inside tasks of bounded size, and only
what proves similar is sent on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import hashing
from tidemark.llm.components import components
from tidemark.llm.frames import binaries, column, content_key, given_id, known_id, longs, map_slices, record, sorted_blocks, values
from tidemark.session import stored

BANDS, ROWS = 32, 6
SHINGLE_WORDS = 5
THRESHOLD = 0.8
# Signatures of similar pairs agree this much but for one pair in 1e9 (six standard deviations below the threshold).
SIGNATURE_LEAST = 0.62
BLOCK_ROWS = 50_000
# Members of a bucket that one task compares; larger buckets are dealt out as pairs of blocks.
BLOCK_MEMBERS = 2_000
# The lowest bits of a bucket's number say which band it is of.
_BAND_BITS = np.uint64(63)
_ROUND = np.uint64(0xD1B54A32D192ED03)
# A member of a bucket as it is shuffled; values of parts that are unpacked at once, at least.
_MEMBER = np.dtype([("id", "<i8"), ("low", "<u4")])
PARTS_VALUES = 256


def registers(elements: np.ndarray, owner: np.ndarray, weights: np.ndarray, owners: int, size: int) -> np.ndarray:
    """The winning element of each register, a row per owner. Owners without elements get zeros."""
    first = np.full(owners * size, np.inf)
    won = np.zeros(owners * size, np.uint64)
    used = np.zeros(owners, bool)
    used[owner] = True
    time = np.zeros(len(elements))
    turn = 0
    while len(elements):
        turn = (turn + int(_ROUND)) & 0xFFFFFFFFFFFFFFFF
        drawn = hashing.mix(elements + np.uint64(turn))
        time = time - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights
        slot = owner * size + (hashing.mix(drawn) % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, slot, time)
        wins = time == first[slot]
        won[slot[wins]] = elements[wins]
        latest = first.reshape(owners, size).max(axis=1)
        alive = time < latest[owner]
        elements, owner, weights, time = elements[alive], owner[alive], weights[alive], time[alive]
    return won.reshape(owners, size)


def weighted_shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order, the text's index, and weight ``1 + ln(count)``.

    A text with fewer words than a shingle is one shingle of all its words; one without words has none.
    """
    data, begins = hashing.flat(texts)
    starts, ends, first = hashing.word_spans(data, begins)
    hashes = hashing.span_hashes(data, starts, ends)
    made = hashing.shingles(hashes, words)
    text = np.searchsorted(first, np.arange(len(made)), "right") - 1
    inside = np.arange(len(made)) + words <= first[text + 1] if len(made) else np.zeros(0, bool)
    made, text = made[inside], text[inside]
    counts = np.diff(first)
    for i in np.flatnonzero((counts > 0) & (counts < words)):
        made = np.append(made, hashing.shingles(hashes[first[i] : first[i + 1]], int(counts[i])))
        text = np.append(text, i)
    order = np.lexsort((made, text))
    made, text = made[order], text[order]
    new = np.flatnonzero(np.append(True, (made[1:] != made[:-1]) | (text[1:] != text[:-1]))) if len(made) else order
    count = np.diff(np.append(new, len(made)))
    return made[new], text[new], 1.0 + np.log(count) if len(count) else count.astype(float)


def band_hashes(won: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(won), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        out = hashing.mix(out * _ROUND + won[:, k : bands * rows : rows])
    return (out & ~_BAND_BITS) | np.arange(bands, dtype=np.uint64)


def probability_jaccard(x: np.ndarray, wx: np.ndarray, y: np.ndarray, wy: np.ndarray) -> float:
    """Exact similarity of two weighted sets, given by sorted elements and weights."""
    if not len(x) or not len(y):
        return 0.0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    shared = y[at] == x
    if not shared.any():
        return 0.0
    only_x, only_y = wx[~shared].sum(), wy.sum() - wy[at[shared]].sum()
    a, b = wx[shared], wy[at[shared]]
    order = np.argsort(a / b, kind="stable")
    a, b = a[order], b[order]
    ratio = a / b
    # The larger of the two ratios is the first for elements further right, the second for those further left.
    left = np.searchsorted(ratio, ratio, "left")
    upper = np.append(np.cumsum(a[::-1])[::-1], 0.0)[left] + only_x
    lower = np.append(0.0, np.cumsum(b))[left] + only_y
    return float((1.0 / (upper / a + lower / b)).sum())


def _texts(rows: DataFrame, words: int, bands: int, in_band: int) -> DataFrame:
    """Each distinct text with words: number, content key, smallest id, registers."""
    size = bands * in_band

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        made, text, weight = weighted_shingles(column(batch, "lower"), words)
        if not len(made):
            return None
        won = registers(made, text, weight, batch.num_rows, size)
        full = np.unique(text)
        take = pa.array(full)
        sign = pa.array([won[i].tobytes() for i in full], pa.binary())
        return record(k1=column(batch, "k1").take(take), k2=column(batch, "k2").take(take), doc=column(batch, "doc").take(take), won=sign)

    signed = map_slices(
        rows.select("doc", "k1", "k2", F.lower("text").alias("lower")), "lower", work, "k1 long, k2 long, doc long, won binary"
    )
    # Copies of a text have one signature; a task sends it once.
    distinct = signed.groupBy("k1", "k2").agg(F.min("doc").alias("doc"), F.first("won").alias("won"))
    return stored(distinct.withColumn("id", F.monotonically_increasing_id()), "texts")


def packed_members(bucket: np.ndarray, ident: np.ndarray) -> pa.RecordBatch:
    """Members of buckets by parts, each with its members as one value of 12 bytes a member: a shuffle of very many members
    has few rows then. Buckets are told apart by 44 bits: they choose candidates only."""
    kept = np.empty(len(bucket), _MEMBER)
    order = np.argsort(bucket)
    bucket = bucket[order]
    kept["id"], kept["low"] = ident[order], bucket >> np.uint64(20)
    part = (bucket >> np.uint64(52)).astype(np.int32)
    start = np.flatnonzero(np.append(True, part[1:] != part[:-1]))[: len(part)]
    ends = np.append(start[1:], len(part)) if len(part) else start
    return record(part=part[start], members=binaries(kept.view(np.uint8), ends * _MEMBER.itemsize))


def _members(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Blocks of buckets and ids in order of bucket, and whether the last bucket goes on."""
    for block, open_ in sorted_blocks(batches, "bucket", block_rows):
        yield block.column("bucket").to_numpy(), block.column("id").to_numpy(), open_


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """The same of :func:`packed_members`, whole parts at a time."""
    for block, _ in sorted_blocks(batches, "part", PARTS_VALUES, lambda _: False):
        values_ = block.column("members").to_pylist()
        kept = np.frombuffer(b"".join(values_), _MEMBER)
        part = np.repeat(block.column("part").to_numpy().astype(np.int64), [len(v) // _MEMBER.itemsize for v in values_])
        bucket = part << 32 | kept["low"].astype(np.int64)
        order = np.argsort(bucket)
        yield bucket[order], kept["id"][order], False


def bucket_links(members: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Columns ``bucket``, ``id`` in, or those of :func:`packed_members`; every member of a bucket of two or more with the
    bucket's ``leader`` and the member ``before`` (both the member itself for the leader) out. Members may repeat; one that
    does in a bucket of over ``block_rows`` rows may come out once for each block of them."""
    key = "part" if "part" in members.columns else "bucket"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        going_on, leader, before = None, 0, 0
        for bucket, ident, open_ in _unpacked(batches) if key == "part" else _members(batches, block_rows):
            # Rows come in order of bucket alone, which Spark sorts much faster. Most are the only ones of their bucket.
            start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            more = np.diff(np.append(start, len(bucket))) > 1
            more[0] |= going_on is not None and bucket[0] == going_on
            more[-1] |= open_
            more = np.repeat(more, np.diff(np.append(start, len(bucket))))
            bucket, ident = bucket[more], ident[more]
            order = np.lexsort((ident, bucket))
            bucket, ident = bucket[order], ident[order]
            new = np.ones(len(bucket), bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (ident[1:] != ident[:-1])
            if going_on is not None and len(bucket) and bucket[0] == going_on and ident[0] == before:
                new[0] = False
            bucket, ident = bucket[new], ident[new]
            if not len(bucket):
                continue
            head = np.append(True, bucket[1:] != bucket[:-1])
            start = np.flatnonzero(head)
            size = np.diff(np.append(start, len(bucket)))
            lead = np.repeat(ident[start], size)
            prior = np.append(ident[0], ident[:-1])
            prior[head] = ident[head]
            keep = np.repeat(size > 1, size)
            if going_on is not None and bucket[0] == going_on:
                lead[: size[0]], prior[0], keep[: size[0]] = leader, before, True
            if open_:
                keep[-size[-1] :] = True
                leader = lead[-1]
            going_on, before = (bucket[-1], ident[-1]) if open_ else (None, 0)
            yield record(bucket=bucket[keep], id=ident[keep], leader=lead[keep], before=prior[keep])

    ordered = members.repartition(key).sortWithinPartitions(key)
    return ordered.mapInArrow(run, "bucket long, id long, leader long, before long")


def _verified(pairs: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a``, ``b`` whose texts are as similar as asked for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [column(batch, c) for c in ("xs", "xw", "ys", "yw")]
            keep = [
                probability_jaccard(
                    np.frombuffer(xs.as_buffer(), np.uint64), np.frombuffer(xw.as_buffer(), np.float64),
                    np.frombuffer(ys.as_buffer(), np.uint64), np.frombuffer(yw.as_buffer(), np.float64),
                ) >= threshold - 1e-12
                for xs, xw, ys, yw in zip(*raw)
            ]
            keep = np.array(keep, bool)
            yield record(a=values(batch, "a")[keep], b=values(batch, "b")[keep])

    left = shingles.select(F.col("id").alias("a"), F.col("elements").alias("xs"), F.col("weights").alias("xw"))
    right = shingles.select(F.col("id").alias("b"), F.col("elements").alias("ys"), F.col("weights").alias("yw"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(work, "a long, b long")


def _shingles(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Weighted shingles of the wanted texts, as sorted unsigned numbers and doubles, and 16 bits of each register."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made, text, weight = weighted_shingles(column(batch, "lower"), words)
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
        parts = list(zip(cut, cut[1:]))
        return record(
            id=column(batch, "id"),
            elements=pa.array([made[a:b].tobytes() for a, b in parts], pa.binary()),
            weights=pa.array([weight[a:b].tobytes() for a, b in parts], pa.binary()),
            sign=pa.array([_numbers(x, np.uint64).astype(np.uint16).tobytes() for x in column(batch, "won")], pa.binary()),
        )

    one = rows.join(wanted, ["k1", "k2", "doc"]).select("id", "won", F.lower("text").alias("lower"))
    made = map_slices(one, "lower", work, "id long, elements binary, weights binary, sign binary")
    return stored(made.dropDuplicates(["id"]), "shingles")


def _numbers(value: pa.BinaryScalar, kind: type) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def meetings(members: DataFrame, label: DataFrame, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """Members of buckets that are not united so far, dealt out as meetings of two blocks of a bucket.

    Buckets of two or three have nothing left: their leader and their chain are all pairs.
    """
    named = members.select("bucket", "id").join(label.select(F.col("node").alias("id"), "root"), "id", "left")
    named = named.withColumn("root", F.coalesce("root", "id"))
    open_ = named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"))
    open_ = open_.where("lo < hi and n > 3").select("bucket", F.ceil(F.col("n") / block_members).cast("int").alias("blocks"))
    dealt = named.join(open_, "bucket").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # A block meets every block, itself included, in a task of their own.
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("meeting"), "own", "id", "root",
        (F.col("own") == F.col("other")).alias("same"),
    )


# Gets a block of meetings; two tests of pairs of rows, given by their places: a quick one that lets similar pairs
# through, and the exact one.
Test = Callable[[np.ndarray, np.ndarray], np.ndarray]
Judge = Callable[[pa.Table], tuple[Test, Test]]
# Pairs of rows that are tested at once.
PAIRS = 1 << 18


def _pairs(block: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of members that meet and have different roots, some pairs at a time."""
    meeting, own, root, same = (block.column(c).to_numpy() for c in ("meeting", "own", "root", "same"))
    # Members of one root lie side by side, so those of another are behind them: pairs of one root are not made.
    order = np.lexsort((root, meeting))
    new = np.flatnonzero(np.append(True, (meeting[order][1:] != meeting[order][:-1]) | (root[order][1:] != root[order][:-1])))
    first = np.repeat(np.append(new[1:], len(meeting)), np.diff(np.append(new, len(meeting))))
    partners = np.searchsorted(meeting, meeting, "right") - first
    total = np.cumsum(partners)
    at = 0
    while at < len(meeting):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + PAIRS, "right")))
        i = order[np.repeat(np.arange(at, to), partners[at:to])]
        j = np.arange(len(i)) - np.repeat(total[at:to] - partners[at:to] - done, partners[at:to])
        j = order[j + np.repeat(first[at:to], partners[at:to])]
        at = to
        open_ = same[i] | (own[i] != own[j])
        yield i[open_], j[open_]


def with_partners(dealt: DataFrame, judge: Callable[[pa.Table], Test]) -> DataFrame:
    """The members that the quick test pairs with one of another root, by the columns of :func:`meetings`.

    What the exact test needs may be joined to these; it is wider, and most members have no partner.
    """
    columns = ["meeting", "own", "id", "root", "same"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in sorted_blocks(batches, "meeting", 1000, lambda _: False):
            near, paired = judge(block), np.zeros(len(block), bool)
            for i, j in _pairs(block):
                keep = near(i, j)
                paired[i[keep]] = paired[j[keep]] = True
            if paired.any():
                yield from block.select(columns).filter(pa.array(paired)).to_batches()

    ordered = dealt.repartition("meeting").sortWithinPartitions("meeting")
    return ordered.mapInArrow(run, dealt.select(*columns).schema)


def links_across(dealt: DataFrame, judge: Judge) -> DataFrame:
    """Links between members of one bucket with different roots. Tasks compare; only links are sent on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in sorted_blocks(batches, "meeting", 1000, lambda _: False):
            ident, tests = block.column("id").to_numpy(), judge(block)
            for i, j in _pairs(block):
                for test in tests:
                    keep = test(i, j)
                    i, j = i[keep], j[keep]
                if len(i):
                    yield record(a=np.minimum(ident[i], ident[j]), b=np.maximum(ident[i], ident[j]))

    ordered = dealt.repartition("meeting").sortWithinPartitions("meeting")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def _across(members: DataFrame, label: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    def judge(block: pa.Table) -> tuple[Test, Test]:
        elements = [_numbers(x, np.uint64) for x in block.column("elements")]
        weights = [_numbers(x, np.float64) for x in block.column("weights")]
        sign = np.stack([_numbers(x, np.uint16) for x in block.column("sign")])

        def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            keep = np.zeros(len(i), bool)
            for a in range(0, len(i), 8192):
                keep[a : a + 8192] = (sign[i[a : a + 8192]] == sign[j[a : a + 8192]]).mean(axis=1) >= SIGNATURE_LEAST
            return keep

        def alike(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            pairs = zip(i.tolist(), j.tolist())
            found = [probability_jaccard(elements[p], weights[p], elements[q], weights[q]) >= threshold - 1e-12 for p, q in pairs]
            return np.array(found, bool)

        return near, alike

    return links_across(meetings(members, label).join(shingles, "id"), judge)


def near_duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD, bands: int = BANDS, in_band: int = ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Rows (``doc``, ``k1``, ``k2``) of ``docs``, and the class of every distinct text.

    The second frame has ``k1``, ``k2``, the class as its smallest known id ``class_doc`` and the
    content key ``c1``, ``c2`` of the row that stands for the class. Texts without words are in no class.
    """
    rows = docs.select(known_id(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).cast("string").alias("text"))
    rows = rows.select("doc", "text", *content_key(F.col("text")))
    texts = _texts(rows, words, bands, in_band)

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            won = np.stack([np.frombuffer(x.as_buffer(), np.uint64) for x in column(batch, "won")]) if batch.num_rows else np.zeros((0, bands * in_band), np.uint64)
            made = band_hashes(won, bands, in_band)
            yield record(bucket=longs(made.ravel()), id=np.repeat(values(batch, "id"), bands))

    members = stored(bucket_links(texts.select("id", "won").mapInArrow(banded, "bucket long, id long")), "buckets")
    wanted = texts.join(members.select("id").distinct(), "id").select("k1", "k2", "doc", "id", "won")
    shingles = _shingles(rows, wanted, words)
    # First each text with one leader; then the other candidates that this has not united.
    nearest = members.where("id != leader").groupBy("id").agg(F.min("leader").alias("a"))
    links = stored(_verified(nearest.select("a", F.col("id").alias("b")), shingles, threshold), "links")
    label = components(links)
    lead, chain = members.select(F.col("leader").alias("a"), F.col("id").alias("b")), members.select("before", "id")
    more = lead.union(chain).where("a != b").distinct()
    links = links.union(stored(_verified(apart(more, label), shingles, threshold), "links"))
    label = components(links)
    rest = stored(_across(members, label, shingles, threshold), "links")
    label = components(links.union(rest))
    named = texts.select("k1", "k2", "doc", "id").join(label.select(F.col("node").alias("id"), "root"), "id", "left")
    named = named.withColumn("root", F.coalesce("root", "id"))
    head = named.groupBy("root").agg(F.min(F.struct("doc", "k1", "k2")).alias("head"))
    classes = named.join(head, "root").select(
        "k1", "k2", F.col("head.doc").alias("class_doc"), F.col("head.k1").alias("c1"), F.col("head.k2").alias("c2")
    )
    return rows, classes


def apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose ends are not united so far."""
    for end in ("a", "b"):
        pairs = pairs.join(label.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    return pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: its id and ``class_id``, the smallest id among its near duplicates.

    Two documents are linked if the probability Jaccard similarity of their lower-case word
    shingles, weighted by ``1 + ln(count)``, is ``threshold`` or more; classes are the connected
    components. A document without words (null, empty, blank) is a class of its own. A null id
    counts as larger than any; a class without known ids has a null ``class_id``. Rows that repeat
    an id are documents of their own. Other columns are not looked at.
    """
    rows, classes = near_duplicate_classes(docs, id_col, text_col, **options)
    found = rows.select("doc", "k1", "k2").join(classes, ["k1", "k2"], "left")
    return found.withColumn("class_doc", F.coalesce("class_doc", "doc")).select(
        given_id("doc").alias(id_col), given_id("class_doc").alias("class_id")
    )


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their class: the smallest id, of equal ones one row.

    Every document without words stays.
    """
    _, classes = near_duplicate_classes(docs, id_col, text_col, **options)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    has_words = text.rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.where(has_words).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), known_id(f"`{id_col}`").alias("doc"), *content_key(text)
    )
    heads = keyed.join(classes, ["k1", "k2"]).where("doc = class_doc and k1 = c1 and k2 = c2")
    heads = heads.groupBy("k1", "k2").agg(F.first("_row").alias("_row"))
    return heads.select("_row.*").unionByName(docs.where(~has_words))
