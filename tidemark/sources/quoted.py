"""Quoted delimited text whose fields may hold line breaks, read by many tasks.

Whether a line break ends a record depends on all that comes before it in the file. So a first pass finds for each scan
split in which state it ends, inside a quoted field or not, for both states it may begin in. Put one after the other
these give the state each split begins in. A second pass cuts records from that state on; what goes over the end of a
split is put together from its pieces, at most two per split. Nothing is sorted or shuffled but these.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import broadcast_if_small, ship_package, stored
from tidemark.sources.files import PLAIN_NAME, literal, logical_name
from tidemark.sources.tsv import BROADCAST_SPLITS

QUOTE = '"'
WHOLE, BEGINS, GOES_ON, ENDS = range(4)
# Records handed over at once.
BATCH = 1000


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a line ends within a quoted field. Quotes count at the start of a field only; two in a row are one."""
    at = 0
    while True:
        if inside:
            while True:
                at = line.find(QUOTE, at)
                if at < 0:
                    return True
                if not line.startswith(QUOTE, at + 1):
                    break
                at += 2
            at, inside = at + 1, False
        # The next field that begins with a quote.
        if at == 0 and line.startswith(QUOTE):
            at, inside = 1, True
            continue
        at = line.find(sep + QUOTE, at)
        if at < 0:
            return False
        at, inside = at + len(sep) + 1, True


def quoted_lines(spark: SparkSession, paths: Sequence[str], name_pattern: str = PLAIN_NAME) -> DataFrame:
    """Physical lines with their scan split. Only line feeds end a line, so other breaks stay as they are."""
    text = spark.read.option("lineSep", "\n").text([literal(p) for p in paths])
    meta = F.col("_metadata.file_path")
    return text.select(
        "value", logical_name(meta, name_pattern, encoded=True).alias("source_file"), meta.alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, list[str], pa.RecordBatch]]:
    """The lines of a batch, cut where the split changes."""
    path, block = batch.column("path"), batch.column("block")
    starts = pc.indices_nonzero(_new_split(batch)).to_pylist()
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        part = batch.slice(start, end - start)
        yield path[start].as_py(), block[start].as_py(), part.column("value").to_pylist(), part


def split_states(lines: DataFrame, sep: str) -> DataFrame:
    """One row per split: ``path``, ``block``, whether it begins ``inside`` a quoted field, and whether a field goes over an end of it (``cut``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[tuple[str, int], list[bool]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            # Only lines with a quote change anything.
            keep = pc.match_substring(batch.column("value"), QUOTE)
            first = batch.slice(0, 1)
            ends.setdefault((first.column("path")[0].as_py(), first.column("block")[0].as_py()), [False, True])
            for path, block, values, _ in _runs(batch.filter(pc.or_(keep, _new_split(batch)))):
                state = ends.setdefault((path, block), [False, True])
                for value in values:
                    state[0], state[1] = ends_inside(value, state[0], sep), ends_inside(value, state[1], sep)
        if ends:
            yield pa.RecordBatch.from_pydict({
                "path": [p for p, _ in ends], "block": [b for _, b in ends],
                "from_out": [x for x, _ in ends.values()], "from_in": [x for _, x in ends.values()],
            })

    reported = lines.select("value", "path", "block").mapInArrow(run, "path string, block long, from_out boolean, from_in boolean")
    # A list per file, with an entry per split.
    files = reported.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("block", "from_out", "from_in"))).alias("splits"))
    start = F.struct(F.lit(False).alias("state"), F.array().cast("array<struct<block: bigint, inside: boolean, cut: boolean>>").alias("begins"))
    ends = lambda acc, x: F.when(acc.state, x.from_in).otherwise(x.from_out)
    begins = lambda acc, x: F.struct(x.block.alias("block"), acc.state.alias("inside"), (acc.state | ends(acc, x)).alias("cut"))
    scan = F.aggregate(
        "splits", start,
        lambda acc, x: F.struct(ends(acc, x).alias("state"), F.concat(acc.begins, F.array(begins(acc, x))).alias("begins")),
    )
    return files.select("path", F.explode(scan.begins).alias("s")).select("path", "s.block", "s.inside", "s.cut")


def _new_split(batch: pa.RecordBatch) -> pa.Array:
    """Marks the first line of each split, so that a split without quotes reports too."""
    block, path = batch.column("block"), batch.column("path")
    if batch.num_rows < 2:
        return pa.array([True] * batch.num_rows)
    changed = pc.or_(pc.not_equal(block[1:], block[:-1]), pc.not_equal(path[1:], path[:-1]))
    return pa.concat_arrays([pa.array([True]), changed])


def _records(lines: DataFrame, states: DataFrame, sep: str) -> DataFrame:
    """Whole records and pieces of those that go over the end of a split; ``first`` is set for the first one of a file."""
    schema = "source_file string, path string, block long, kind int, record string, first boolean"
    placed = lines.join(broadcast_if_small(states, BROADCAST_SPLITS), ["path", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        at, name, held, inside, begun, first = None, None, [], False, True, False

        def close(kind_if_begun: int, kind_else: int) -> None:
            nonlocal held, first
            if held:
                out.append((name, *at, kind_if_begun if begun else kind_else, "\n".join(held), first))
            held, first = [], False

        def made() -> pa.RecordBatch:
            names = ("source_file", "path", "block", "kind", "record", "first")
            types = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], list(names))

        for batch in batches:
            for path, block, values, part in _runs(batch) if batch.num_rows else ():
                if (path, block) != at:
                    close(BEGINS, GOES_ON)
                    at, name = (path, block), part.column("source_file")[0].as_py()
                    inside = part.column("inside")[0].as_py()
                    begun, first = not inside, block == 0
                for value in values:
                    held.append(value)
                    if QUOTE in value:
                        inside = ends_inside(value, inside, sep)
                    if not inside:
                        close(WHOLE, ENDS)
                        begun = True
                    if len(out) >= BATCH:
                        yield made()
                        out.clear()
        close(BEGINS, GOES_ON)
        if out:
            yield made()

    return placed.select("value", "source_file", "path", "block", "inside").mapInArrow(run, schema)


def quoted_records(spark: SparkSession, paths: Sequence[str], sep: str = "\t", *, name_pattern: str = PLAIN_NAME) -> DataFrame:
    """Records as text, line breaks in quoted fields included: ``source_file``, ``record``, ``first``.

    A quoted field that is open at the end of a file ends there. Blank lines between records are left out.
    """
    ship_package(spark)
    lines = quoted_lines(spark, paths, name_pattern)
    states = stored(split_states(lines, sep), "states")
    # Pieces come only from splits that a field goes over the end of.
    pieces = _records(lines, states.where("cut"), sep).where(F.col("kind") != WHOLE)
    # Of one split the end of a record comes before the beginning of another.
    in_file = W.partitionBy("path").orderBy("block", F.desc("kind")).rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = pieces.withColumn("number", F.sum((F.col("kind") == BEGINS).cast("int")).over(in_file))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("block", "record"))), lambda x: x.record)
    whole = numbered.groupBy("source_file", "path", "number").agg(F.array_join(texts, "\n").alias("record"), F.max("first").alias("first"))
    columns = ["source_file", "record", "first"]
    found = _records(lines, states, sep).where(F.col("kind") == WHOLE).select(columns).union(whole.select(columns))
    return found.withColumn("record", F.regexp_replace("record", r"\r$", "")).where(F.col("record").rlike(r"\S"))


def scan_quoted(spark: SparkSession, paths: Sequence[str], sep: str = "\t", *, name_pattern: str = PLAIN_NAME) -> DataFrame:
    """Quoted delimited files with one header line of their own each, all columns as text, and ``source_file``.

    An empty field is null. A row with another number of fields than the header of the first file stops the query.
    """
    header = spark.read.text(literal(paths[0])).where(F.trim("value") != "").first()
    if header is None:
        raise ValueError(f"no header in {paths[0]}")
    names = next(csv.reader([header.value.lstrip("\ufeff")], delimiter=sep))
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "mode": "FAILFAST"}
    fields = F.from_csv("record", ", ".join(f"`{n}` STRING" for n in names), options)
    rows = quoted_records(spark, paths, sep, name_pattern=name_pattern).where("NOT first").select("source_file", fields.alias("r"))
    return rows.select("source_file", "r.*")
