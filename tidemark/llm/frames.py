"""Helpers for operators that work on Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ship_package

# What a Python worker handles at once. They bound memory, not results.
SLICE_BYTES = 1 << 19
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20
NO_ID = (1 << 63) - 1


def bounded(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a worker's memory does not depend on the length of the texts; workers get this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def known_id(column: str = "doc_id") -> Column:
    """An id that is never null: a null id counts as larger than any other."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def given_id(column: str) -> Column:
    """Back from :func:`known_id`."""
    return F.when(F.col(column) != NO_ID, F.col(column))


def content_key(text: Column) -> list[Column]:
    """``k1`` and ``k2``, 128 bits that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("content"), text).alias("k2")]


def _cut(batch: pa.RecordBatch, size: np.ndarray) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(size + 1)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces with about ``SLICE_BYTES`` of text; a longer text is a piece of its own."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        yield from _cut(batch, np.asarray(pc.binary_length(column).fill_null(0).cast(pa.int64())))


def map_slices(df: DataFrame, text: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``work`` to pieces of bounded text size."""

    def run(batches):
        for piece in slices(batches, text):
            made = work(piece)
            if made is not None and made.num_rows:
                yield made

    return df.mapInArrow(run, schema)


def packed(df: DataFrame, text: str) -> DataFrame:
    """The column ``text``, in which nothing is null, compressed: rows that are shuffled with their texts take less room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            made = [pack(x.as_buffer()) for x in column(batch, text).cast(pa.large_binary())]
            yield batch.set_column(batch.schema.get_field_index(text), text, pa.array(made, pa.binary()))

    schema = ", ".join(f"{c} {'binary' if c == text else kind}" for c, kind in df.dtypes)
    return df.mapInArrow(run, schema)


def map_packed(df: DataFrame, text: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """As :func:`map_slices`, for a column made by :func:`packed`; pieces are cut by the size of the texts as they were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            at = batch.schema.get_field_index(text)
            size = [zstandard.frame_content_size(x.as_buffer()) for x in batch.column(at)]
            for piece in _cut(batch, np.array(size, np.int64)):
                made = work(piece.set_column(at, text, pa.array([unpack(x.as_buffer()) for x in piece.column(at)], pa.binary())))
                if made is not None and made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)


def record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], list(columns))


def longs(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def values(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return column(batch, name).to_numpy(zero_copy_only=False)


def spread(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ``size`` places from each of ``at`` on, one after the other."""
    return np.repeat(at - np.cumsum(size) + size, size) + np.arange(size.sum())


def binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary array cut from one buffer at ``ends``."""
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def sorted_blocks(
    batches: Iterator[pa.RecordBatch], key: str, rows: int, may_cut: Callable[[int], bool] = lambda _: True
) -> Iterator[tuple[pa.Table, bool]]:
    """Put batches of a partition sorted by ``key`` together into blocks of at least ``rows`` rows
    that end where a key ends. A key with more rows is cut if ``may_cut`` allows it: True says that
    the last key goes on.
    """
    held, n, wanted = [], 0, rows
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < wanted:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if cut == 0 and may_cut(int(keys[-1])):
            yield table, True
            held, n, wanted = [], 0, rows
            continue
        if cut:
            yield table.slice(0, cut), False
        rest = table.slice(cut)
        held, n = rest.to_batches(), rest.num_rows
        # Copying what is held again and again would cost its square.
        wanted = max(rows, 2 * n)
    if held:
        yield pa.Table.from_batches(held).combine_chunks(), False


# Bits of a filter of ids: 8 MB, whatever the number of ids.
FILTER_BITS = 26


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bit map of fixed size in which the slots of the ids in the only column are set."""
    slot = F.col(ids.columns[0]).bitwiseAND((1 << FILTER_BITS) - 1)
    parts = ids.select(slot.alias("slot")).groupBy(F.shiftright("slot", 15).alias("part"))
    out = np.zeros((1 << FILTER_BITS) >> 3, np.uint8)
    for part, bits in parts.agg(F.expr("bitmap_construct_agg(slot & 32767)").alias("bits")).toLocalIterator():
        out[part * 4096 : (part + 1) * 4096] = np.frombuffer(bits, np.uint8)
    return out


def in_filter(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """False for ids that are not in the filter for certain."""
    slot = ids & ((1 << FILTER_BITS) - 1)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
