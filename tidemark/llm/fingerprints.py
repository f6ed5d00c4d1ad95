"""Exact copies by polynomial fingerprints, which compose.

The fingerprint of a byte string is its polynomial at two points of the field of 2^61 - 1 elements. That of two strings in
a row follows from theirs: the second is shifted by the length of the first. So a huge document is cut into chunks, which
tasks hash on their own, each shifted by what lies before it, and a sum makes the document's fingerprint.

Equal fingerprints only name candidates. Their texts are compared chunk by chunk: a task lets through one of each
distinct chunk, so a group of any number of copies travels once per task, and a chunk that is found in two versions
takes its group apart.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm import hashing
from tidemark.llm.frames import FILTER_BITS, column, id_filter, in_filter, map_slices, record, slices, values
from tidemark.session import discard, stored

MODULUS = (1 << 61) - 1
BASES = (0x0E3779B97F4A7C15, 0x1F58476D1CE4E5B9)
# Longer texts are cut, and their chunks dealt out over the tasks.
CHUNK_BYTES = 1 << 20
_MARK = ["f1", "f2", "n_bytes"]

_P = np.uint64(MODULUS)
_B31, _B30, _B61 = np.uint64(31), np.uint64(30), np.uint64(61)
_M31, _M30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _B61)
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2^61 - 1 of numbers below it."""
    a, b = np.asarray(a, np.uint64), np.asarray(b, np.uint64)
    a_hi, a_lo, b_hi, b_lo = a >> _B31, a & _M31, b >> _B31, b & _M31
    middle = a_hi * b_lo + a_lo * b_hi
    return _reduced(np.uint64(2) * a_hi * b_hi + (middle >> _B30) + ((middle & _M30) << _B31) + a_lo * b_lo)


@cache
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The upper and the lower bits of the first powers of a base, ``size`` of them, a power of two."""
    made = np.ones(1, np.uint64)
    while len(made) < size:
        made = np.append(made, times(made, np.uint64(pow(base, len(made), MODULUS))))
    return (made >> _B31).astype(np.uint32), (made & _M31).astype(np.uint32)


def chunk_hashes(data: np.ndarray, begins: np.ndarray, base: int) -> np.ndarray:
    """``sum((byte[i] + 1) * base^i)`` of each chunk; ``begins`` has one entry more than chunks."""
    out = np.zeros(len(begins) - 1, np.uint64)
    full = np.flatnonzero(np.diff(begins))
    if not len(full):
        return out
    n = len(data)
    hi, lo = _powers(base, 1 << max(16, int(n).bit_length()))
    wide = data.astype(np.uint64) + np.uint64(1)
    starts = begins[:-1][full]
    upper, lower = (_reduced(np.add.reduceat(wide * part[:n], starts)) for part in (hi, lo))
    at_place = _reduced(times(upper, np.uint64(1 << 31)) + lower)
    # Each sum has begun at the chunk's place in the batch; lifted to one common place, all come down by one number.
    lift = (hi[n - starts].astype(np.uint64) << _B31) + lo[n - starts]
    out[full] = times(times(at_place, lift), np.uint64(pow(base, -n, MODULUS)))
    return out


def shifted(hashes: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The share of chunks in the hash of a text in which ``lengths`` bytes precede them."""
    power = np.array([pow(base, int(n), MODULUS) for n in lengths], np.uint64)
    return times(hashes, power)


def _lowered(body: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, begins = hashing.flat(body)
    return _LOWER[data], begins


def _marks(data: np.ndarray, begins: np.ndarray, bases: tuple[int, int]) -> dict[str, np.ndarray]:
    made = {f"f{k + 1}": chunk_hashes(data, begins, base).astype(np.int64) for k, base in enumerate(bases)}
    return {**made, "n_bytes": np.diff(begins)}


def _short(rows: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """Fingerprints of texts of one chunk."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, begins = _lowered(column(batch, "body"))
        raw = memoryview(data)
        digest = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(begins[:-1], begins[1:])]
        return record(doc=column(batch, "doc"), **_marks(data, begins, bases), sha256=digest)

    return map_slices(rows, "body", work, "doc long, f1 long, f2 long, n_bytes long, sha256 string")


def _cut(rows: DataFrame, chunk: int) -> DataFrame:
    """Long texts as numbered chunks in lower case. The digest of a text, which does not compose, is with its last chunk."""
    numbered = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc", F.octet_length("body").cast("long").alias("n_bytes"), "body"
    )
    numbered = numbered.withColumn("no", F.explode(F.sequence(F.lit(0), ((F.col("n_bytes") - 1) / chunk).cast("int"))))
    piece = F.substring("body", F.col("no") * chunk + 1, F.lit(chunk))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The chunks of a text follow each other in one task.
        state = hashlib.sha256()
        for batch in slices(batches, "piece"):
            data, begins = _lowered(column(batch, "piece"))
            raw, digests = memoryview(data), []
            for no, n, a, b in zip(values(batch, "no"), values(batch, "n_bytes"), begins[:-1], begins[1:]):
                state = hashlib.sha256() if no == 0 else state
                state.update(raw[a:b])
                digests.append(state.hexdigest() if (no + 1) * chunk >= n else None)
            cut = pa.array([raw[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:])], pa.binary())
            kept = {c: column(batch, c) for c in ("row", "doc", "n_bytes", "no")}
            yield record(**kept, piece=cut, sha256=pa.array(digests, pa.string()))

    made = numbered.select("row", "doc", "n_bytes", "no", piece.alias("piece"))
    return stored(made.mapInArrow(run, "row long, doc long, n_bytes long, no int, piece binary, sha256 string"), "chunks")


def _long(chunks: DataFrame, chunk: int, bases: tuple[int, int]) -> DataFrame:
    """Fingerprints of texts of several chunks: chunks are hashed wherever they are dealt to, a sum puts them together."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, begins = hashing.flat(column(batch, "piece"))
        before = values(batch, "no").astype(np.int64) * chunk
        made = _marks(data, begins, bases)
        kept = {c: column(batch, c) for c in ("row", "doc", "n_bytes", "sha256")}
        return record(**kept, **{
            f"f{k + 1}": shifted(made[f"f{k + 1}"].astype(np.uint64), before, base).astype(np.int64) for k, base in enumerate(bases)
        })

    schema = "row long, doc long, n_bytes long, sha256 string, f1 long, f2 long"
    shares = map_slices(chunks.repartition("row", "no"), "piece", work, schema)

    def total(name: str) -> Column:
        return (F.sum(F.col(name).cast("decimal(20,0)")) % F.lit(MODULUS).cast("decimal(20,0)")).cast("long").alias(name)

    return shares.groupBy("row", "doc", "n_bytes").agg(total("f1"), total("f2"), F.max("sha256").alias("sha256"))


def _filter(marks: DataFrame) -> np.ndarray:
    """A filter of the fingerprints that two or more rows have."""
    return id_filter(marks.groupBy(*_MARK).count().where("count > 1").select("f1"))


def _short_pieces(rows: DataFrame, bases: tuple[int, int], wanted: np.ndarray) -> DataFrame:
    """Short texts, in lower case, whose fingerprint the filter lets through."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        data, begins = _lowered(column(batch, "body"))
        made = _marks(data, begins, bases)
        keep = np.flatnonzero(in_filter(shared.value, made["f1"]))
        if not len(keep):
            return None
        raw = memoryview(data)
        piece = pa.array([raw[begins[i] : begins[i + 1]].tobytes() for i in keep], pa.binary())
        return record(doc=column(batch, "doc").take(pa.array(keep)), **{k: v[keep] for k, v in made.items()}, piece=piece)

    made = map_slices(rows, "body", work, "doc long, f1 long, f2 long, n_bytes long, piece binary")
    return made.withColumn("no", F.lit(0))


def exact_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, bases: tuple[int, int] = BASES,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``, ``n_bytes`` and ``sha256`` of its text.

    Texts are equal if they are after lower-casing A to Z. Of equal ones that with the largest id stays, and ``keep_id``
    is its id; a null id is smaller than any, so a group of null ids has a null ``keep_id``. Rows are counted one by one: of
    rows that repeat id and text one is kept. A null text is an empty one, and empty texts are equal. Length and
    SHA-256 are those of the text in lower case. Other columns are not looked at. An empty table has no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), text.cast("binary").alias("body"))
    is_long = F.octet_length("body") > chunk_bytes
    short = rows.where(~is_long)
    chunks = _cut(rows.where(is_long), chunk_bytes)
    long = stored(_long(chunks, chunk_bytes, bases), "fingerprints")
    columns = ["doc", *_MARK, "sha256"]
    marks = _numbered(_short(short, bases).select(columns).union(long.select(columns)).withColumn("version", F.lit("")))

    long_pieces = chunks.select("row", "no", "piece").join(long.select("row", *_MARK, "doc", "sha256"), "row")
    pieces = _short_pieces(short, bases, _filter(marks))
    pieces = pieces.select(*_MARK, "no", "piece").union(long_pieces.select(*_MARK, "no", "piece"))
    versions = pieces.groupBy(*_MARK, "no", "piece").count().groupBy(*_MARK, "no").count().where("count > 1")
    doubt = stored(versions.select(_MARK).distinct(), "collisions")
    if not doubt.isEmpty():
        apart = _told_apart(short, long_pieces, doubt, bases)
        marks = _numbered(marks.drop("row").join(doubt, _MARK, "left_anti").unionByName(apart))
    for table in (chunks, long, doubt):
        discard(table)

    group = [*_MARK, "version"]
    heads = marks.groupBy(*group).agg(F.max(F.struct("doc", "row")).alias("head"), F.count("*").alias("group_size"))
    found = marks.join(heads, group)
    return found.select(
        F.col("doc").alias(id_col), F.col("head.doc").alias("keep_id"), "group_size",
        (F.col("row") == F.col("head.row")).alias("kept"), "n_bytes", "sha256",
    )


def _numbered(marks: DataFrame) -> DataFrame:
    return stored(marks.withColumn("row", F.monotonically_increasing_id()), "marks")


def _told_apart(short: DataFrame, long_pieces: DataFrame, doubt: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """The rows of fingerprints that different texts share, with the ``version`` of their text."""
    every = np.full((1 << FILTER_BITS) >> 3, 255, np.uint8)
    some = _short_pieces(short, bases, every).join(doubt, _MARK, "left_semi")
    some = some.withColumns({"row": -1 - F.monotonically_increasing_id(), "sha256": F.sha2("piece", 256)})
    columns = ["row", "doc", *_MARK, "sha256", "no", "piece"]
    all_ = stored(some.select(columns).union(long_pieces.join(doubt, _MARK, "left_semi").select(columns)), "collisions")
    number = F.row_number().over(W.partitionBy(*_MARK, "no").orderBy("piece"))
    versions = all_.select(*_MARK, "no", "piece").distinct().withColumn("version", number)
    per_row = all_.join(versions, [*_MARK, "no", "piece"]).groupBy("row", "doc", *_MARK, "sha256")
    made = per_row.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("no", "version"))), lambda x: x.version), ",").alias("version"))
    return made.drop("row")


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`exact_classes` keeps; of rows that repeat id and text any one."""
    kept = exact_classes(docs, id_col, text_col, **options).where("kept").select(F.col(id_col).alias("_id"), F.col("sha256").alias("_sha"))
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    plain = F.sha2(F.translate(body, string.ascii_uppercase, string.ascii_lowercase), 256)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").cast("long").alias("_id"), plain.alias("_sha"))
    same = F.col("a._id").eqNullSafe(F.col("b._id")) & (F.col("a._sha") == F.col("b._sha"))
    found = keyed.alias("a").join(kept.alias("b"), same, "left_semi")
    return found.groupBy("_id", "_sha").agg(F.first("_row").alias("_row")).select("_row.*")
