"""Text files whose lines are in order, one file per name, without a task that sorts a file."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import OPEN_FILES, settings, ship_package

CODEC = "zstd"
# Lines that are packed together, at most.
LINES = 2000
# Packs that a worker gets at once, in bytes.
BATCH_BYTES = 16 << 20
# Lines that a worker holds to deal them out by range, in bytes.
HELD_BYTES = 48 << 20


def write_sorted_text(
    lines: DataFrame, path: str, names: Mapping[str, Column], files: int, *, order: Sequence[str], parts: int = 1, sample: DataFrame | None = None
) -> None:
    """Write ``line`` to one file per ``number`` (0 to ``files`` - 1, or null) with its lines in order.

    ``names`` has two columns, worked out from ``number``: the name of the file, which becomes a folder, and its first line. Ranges of
    lines are sorted by many tasks; packed, they go to the task that writes their file, which so neither sorts nor holds them.
    There are ``parts`` ranges, or as many as the session has partitions if these are more. ``sample`` has rows of ``number`` and
    ``order`` that tell where to cut; by default all lines do. Lines go to their range packed, too: a pack is a third of its rows.
    """
    spark = lines.sparkSession
    ship_package(spark)
    place = ["number", *order]
    parts = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = _cuts((lines if sample is None else sample).select(*place), parts, place)
    folder = next(iter(names))
    values = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": LINES, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
        "spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES,
    }
    with settings(spark, values):
        placed = lines.select(*place, "line")
        dealt = placed.mapInArrow(_scatter(cuts), "`range` INT, size INT, pack BINARY").repartitionById(parts, "range")
        ranges = dealt.mapInArrow(_gather, placed.schema).sortWithinPartitions(*place).select("number", "line")
        packs = ranges.mapInArrow(_pack, "number INT, part INT, nth INT, size INT, pack BINARY")
        packs = packs.repartitionById(files + 1, F.coalesce("number", F.lit(files))).sortWithinPartitions("number", "part", "nth")
        for name, value in names.items():
            packs = packs.withColumn(name, value)
        text = packs.select("number", *names, "size", "pack").mapInArrow(_unpack, f"`{folder}` STRING, value STRING")
        text.write.partitionBy(folder).text(path)


def _cuts(keys: DataFrame, parts: int, place: Sequence[str]) -> pa.Table:
    """The first key of every range but the first."""
    dealt = keys.repartitionByRange(parts, *place).groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*place)).alias("first"))
    return dealt.orderBy("part").select("first.*").toArrow().slice(1)


def _comparable(rows: pa.Table) -> list[pa.Array]:
    """Columns that Arrow sorts as Spark does: not-a-number comes last there."""
    out = []
    for column in rows.columns:
        if pa.types.is_floating(column.type):
            strange = pc.is_nan(column)
            out.append(strange)
            column = pc.if_else(strange, pa.scalar(0.0, column.type), column)
        out.append(column)
    return out


def _scatter(cuts: pa.Table):
    """Packs of the rows of a range: a row lies in the range that has as many cuts before it, or at it."""

    def packed(batches: Sequence[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        place = rows.select(cuts.column_names)
        keys = _comparable(pa.concat_tables([cuts.cast(place.schema), place]).combine_chunks())
        named = pa.table([*keys, pa.array(np.arange(len(cuts) + len(rows)) >= len(cuts))], [str(i) for i in range(len(keys) + 1)])
        sorted_ = pc.sort_indices(named, [(c, "ascending") for c in named.column_names], null_placement="at_start").to_numpy()
        is_cut = sorted_ < len(cuts)
        number = np.cumsum(is_cut)[~is_cut].astype(np.int32)
        rows = rows.take(pa.array(sorted_[~is_cut] - len(cuts))).combine_chunks()
        ends = [*(np.flatnonzero(np.diff(number)) + 1), len(number)]
        for start, end in zip([0, *ends], ends):
            raw = pa.BufferOutputStream()
            with pa.ipc.new_stream(raw, rows.schema) as out:
                out.write_table(rows.slice(start, end - start))
            raw = raw.getvalue()
            pack = pa.array([pa.compress(raw, codec=CODEC, asbytes=True)], pa.binary())
            values = [pa.array([int(x)], pa.int32()) for x in (number[start], raw.size)]
            yield pa.RecordBatch.from_arrays([*values, pack], ["range", "size", "pack"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if len(batch):
                held.append(batch)
                size += batch.nbytes
            if size >= HELD_BYTES:
                yield from packed(held)
                held, size = [], 0
        if held:
            yield from packed(held)

    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for size, pack in zip(batch["size"].to_pylist(), batch["pack"].to_pylist(), strict=True):
            with pa.ipc.open_stream(pa.decompress(pack, size, codec=CODEC)) as rows:
                yield from rows


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, nth = TaskContext.get().partitionId(), 0
    for batch in batches:
        number, line = batch.columns
        # The lines of a file are next to each other.
        runs = pc.run_end_encode(number).run_ends.to_pylist() if len(batch) else []
        for start, end in zip([0, *runs], runs):
            text = "\n".join(line.slice(start, end - start).to_pylist()).encode()
            counts = [pa.array([n], pa.int32()) for n in (part, nth, len(text))]
            pack = pa.array([pa.compress(text, codec=CODEC, asbytes=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([number.slice(start, 1), *counts, pack], ["number", "part", "nth", "size", "pack"])
            nth += 1


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last = ()
    for batch in batches:
        folder = batch.schema.names[1]
        for number, name, head, size, pack in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = pa.decompress(pack, size, codec=CODEC, asbytes=True).decode()
            if last != (number,):
                text, last = f"{head}\n{text}", (number,)
            # The writer ends a value with a line break.
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([text], pa.string())], [folder, "value"])
