"""An inverted index of passages, and the best passages for texts without looking at all of them.

The index is made of segments: what one task has read of some thousand passages, its postings by term, without a shuffle. The
postings of a term in a segment are ordered by what they can add to a score and cut into blocks, each with the most that it
has. A search first adds up the best postings of its terms: the k-th of these sums is a score that an answer must reach. Terms
that together cannot reach it lead to no passage, nor does a block that cannot even with the best of all other terms. What is
left are candidates, and their scores are added up segment by segment; a segment sends its ``k`` best.
All numbers are whole, so the ranking is that of scoring everything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.plans.retrieval import passages
from tidemark.session import broadcast_if_small, scratch_path, ship_package, stored

BLOCK = 1024
MILLI = 1000
# A segment has this many passages, or those that reach this many terms with repeats.
SEGMENT_PASSAGES, SEGMENT_TERMS = 16_384, 4_000_000
# Queries that are scored together in a segment.
QUERIES = 256
# A table of asked terms with up to this many rows is broadcast.
BROADCAST_TERMS = 500_000
# More than any score.
NEVER = 2**62


def term_list(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), 1)


@dataclass(frozen=True)
class PassageIndex:
    """``lists``: segment, term, block, most, n, and the places (``ats``) and ``impacts`` of the block's postings, by falling impact.

    ``places``: segment, at, key, passage_no. ``copies`` is the most rows that one key has.
    """

    lists: DataFrame
    places: DataFrame
    passages: int
    key: str
    copies: int = 1

    @property
    def postings(self) -> DataFrame:
        """One row per posting: term, key, passage_no, impact."""
        pairs = F.explode(F.arrays_zip("ats", "impacts")).alias("_p")
        each = self.lists.select("segment", "term", "block", pairs).select("segment", "term", "block", F.col("_p.ats").alias("at"), F.col("_p.impacts").alias("impact"))
        return each.join(self.places, ["segment", "at"]).drop("at")

    @property
    def blocks(self) -> DataFrame:
        """segment, term, block, and the most and number of its postings."""
        return self.lists.select("segment", "term", "block", "most", "n")


def build_index(texts: DataFrame, key: str, text: str, *, size: int = 128, step: int = 96, block: int = BLOCK) -> PassageIndex:
    """Index the passages of texts. Passages without a term are left out; passages of rows with one key count as one when they are scored.

    An impact is ``2200 tf`` in thousandths over ``tf + 1.2 (0.25 + 0.75 length / mean length)``.
    """
    spark = texts.sparkSession
    ship_package(spark)
    texts, copies = _together(texts.select(key, text), key)
    split = passages(texts, key, text, size, step).select(key, "passage_no", term_list(F.col("passage")).alias("_terms")).where(F.size("_terms") > 0)
    # The texts are read twice; their passages are larger than they are.
    n, total = split.agg(F.count("*"), F.sum(F.size("_terms"))).first()
    kind = texts.schema[key].dataType.simpleString()
    schema = f"segment LONG, term STRING, block INT, most LONG, n LONG, ats ARRAY<INT>, impacts ARRAY<INT>, at INT, `{key}` {kind}, passage_no INT"
    path = scratch_path(spark, "index")
    split.mapInArrow(_indexer(n, total or 1, block, key), schema).write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(schema).parquet(path)
    lists = table.where("term IS NOT NULL").drop("at", key, "passage_no")
    return PassageIndex(lists, table.where("term IS NULL").select("segment", "at", key, "passage_no"), n, key, copies)


def _together(texts: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Rows that share a key go to one task, one after the other; the others stay where they are."""
    often = texts.groupBy(key).agg(F.count("*").alias("_n")).where(f"_n > 1 AND `{key}` IS NOT NULL")
    often = stored(often, "often")
    copies = often.agg(F.max("_n")).first()[0]
    if not copies:
        return texts, 1
    often = broadcast_if_small(often.select(key), BROADCAST_TERMS)
    again = texts.join(often, key, "left_semi").repartition(key).sortWithinPartitions(key)
    return texts.join(often, key, "left_anti").union(again), copies


def _indexer(n: int, total: int, block: int, key: str):
    names = ["segment", "term", "block", "most", "n", "ats", "impacts", "at", key, "passage_no"]

    def segment(rows: pa.Table, number: int, types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        keys, numbers, lists = (rows.column(i).combine_chunks() for i in range(3))
        order = pc.sort_indices(rows.select([0, 1]), sort_keys=[(c, "ascending") for c in rows.column_names[:2]])
        known = pc.take(keys, order)
        # Equal places are next to each other; a row without a key has none.
        codes = [c.dictionary_encode().indices.to_numpy(zero_copy_only=False) for c in (known.fill_null(known[0]) if known.null_count else known, pc.take(numbers, order))]
        first = np.concatenate([[True], (np.diff(codes[0]) != 0) | (np.diff(codes[1]) != 0)])
        valid = known.is_valid().to_numpy(zero_copy_only=False)
        at = np.empty(len(rows), np.int32)
        at[order.to_numpy()] = np.where(valid, np.cumsum(first) - 1, -1)
        length = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        terms = lists.flatten().dictionary_encode()
        by_name = pc.sort_indices(terms.dictionary).to_numpy()
        place = np.empty(len(by_name), np.int64)
        place[by_name] = np.arange(len(by_name))
        pairs, tf = np.unique(place[terms.indices.to_numpy()] * len(rows) + np.repeat(np.arange(len(rows)), length), return_counts=True)
        term, row = np.divmod(pairs, len(rows))
        mean = 250 + 750 * length[row] * n // total
        impact = 2200 * MILLI * tf // (MILLI * tf + 12 * mean // 10)
        best = np.lexsort((at[row], -impact, term))
        term, row, impact = term[best], row[best], impact[best]
        start = np.flatnonzero(np.concatenate([[True], np.diff(term) != 0]))
        nth = np.arange(len(term)) - np.repeat(start, np.diff(np.append(start, len(term))))
        cut = np.flatnonzero(nth % block == 0)
        ends = np.append(cut, len(term)).astype(np.int32)
        of = lambda kind, values: pa.array(values).cast(kind)
        nothing = lambda count, *kinds: [pa.nulls(count, kind) for kind in kinds]
        arrays = [
            of(types[0], np.full(len(cut), number)), terms.dictionary.take(pa.array(by_name)).take(pa.array(term[cut])).cast(types[1]),
            of(types[2], nth[cut] // block), of(types[3], impact[cut]), of(types[4], np.diff(ends)),
            pa.ListArray.from_arrays(pa.array(ends), of(pa.int32(), at[row])), pa.ListArray.from_arrays(pa.array(ends), of(pa.int32(), impact)),
        ]
        yield pa.RecordBatch.from_arrays([*arrays, *nothing(len(cut), pa.int32(), keys.type, pa.int32())], names)
        one = order.filter(pa.array(first & valid))
        places = [of(pa.int32(), np.arange(len(one))), keys.take(one), numbers.take(one).cast(pa.int32())]
        lead = [of(types[0], np.full(len(one), number)), *nothing(len(one), *types[1:5], pa.list_(pa.int32()), pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([*lead, *places], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        number, held = TaskContext.get().partitionId() << 32, None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, new]) if held is not None else new
            while (end := _end(held)) is not None:
                yield from segment(held.slice(0, end), number, types)
                number, held = number + 1, held.slice(end)
        if held is not None and len(held):
            yield from segment(held, number, types)

    return run


def _end(held: pa.Table) -> int | None:
    """Where a segment is full: between two keys, if more rows are there."""
    reached = np.cumsum(pc.list_value_length(held.column(2)).to_numpy())
    full = min(SEGMENT_PASSAGES, int(np.searchsorted(reached, SEGMENT_TERMS)) + 1)
    if full >= len(held):
        return None
    keys = held.column(0).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    later = np.flatnonzero(np.diff(keys[full - 1 :]))
    return full + int(later[0]) if len(later) else None


def term_weight(df: Column, n: int) -> Column:
    return F.floor(MILLI * F.log(1 + (n - df + 0.5) / (df + 0.5))).cast("long")


def _asked(index: PassageIndex, queries: DataFrame, query: str, text: str) -> DataFrame:
    """The terms of each query with ``weight`` (repeats included) and ``top``, the most a passage can get by one."""
    found = queries.where(F.col(query).isNotNull()).select(query, F.explode(term_list(F.col(text))).alias("term")).groupBy(query, "term").agg(F.count("*").alias("times"))
    found = stored(found, "terms")
    terms = broadcast_if_small(stored(found.select("term").distinct(), "distinct"), BROADCAST_TERMS)
    stats = index.blocks.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"), F.max("most").alias("most"))
    weighed = found.join(stats, "term").withColumn("weight", F.col("times") * term_weight(F.col("df"), index.passages))
    top = F.col("weight") * F.col("most") * index.copies
    return stored(weighed.where("weight > 0").select(query, "term", "weight", top.alias("top")), "asked")


def _bounds(index: PassageIndex, asked: DataFrame, query: str, k: int) -> DataFrame:
    """``asked`` with what the most of a block times its ``weight`` must reach (``need``) to lead to a passage."""
    terms = broadcast_if_small(stored(asked.select("term").distinct(), "distinct"), BROADCAST_TERMS)
    best = index.lists.where("block = 0").join(terms, "term", "left_semi").select("segment", "term", F.explode(F.slice(F.arrays_zip("ats", "impacts"), 1, k)).alias("_p"))
    best = best.select("segment", "term", F.col("_p.ats").alias("at"), F.col("_p.impacts").alias("impact")).where("at >= 0")
    nth = F.row_number().over(W.partitionBy("term").orderBy(F.desc("impact"), "segment", "at"))
    first = best.withColumn("_n", nth).where(F.col("_n") <= k).join(asked, "term")
    sums = first.groupBy(query, "segment", "at").agg(F.sum(F.col("weight") * F.col("impact")).alias("sum"))
    order = F.row_number().over(W.partitionBy(query).orderBy(F.desc("sum")))
    least = sums.withColumn("_n", order).where(F.col("_n") == k).select(query, F.col("sum").alias("least"))
    by_top = W.partitionBy(query).orderBy("top", "term").rowsBetween(W.unboundedPreceding, W.currentRow)
    bounds = asked.withColumns({"reach": F.sum("top").over(by_top), "all": F.sum("top").over(W.partitionBy(query))})
    bounds = bounds.join(least, query, "left").withColumn("least", F.coalesce("least", F.lit(0)))
    need = F.when(F.col("reach") >= F.col("least"), F.expr(f"(least - all + top) / {index.copies}")).otherwise(NEVER)
    return bounds.select(query, "term", "weight", F.floor(need).alias("need"))


def candidates(index: PassageIndex, asked: DataFrame, query: str, k: int) -> DataFrame:
    """Passages that may be among the best ``k`` of a query; all others are below the ``k``-th for certain."""
    blocks = _bounds(index, asked, query, k).join(index.lists, "term").where("weight * most >= need")
    found = blocks.select(query, "segment", F.explode("ats").alias("at")).distinct()
    return found.join(index.places, ["segment", "at"]).select(query, index.key, "passage_no")


def _best_of_segment(k: int, kind: pa.DataType):
    """Scores of the candidates of one segment for some queries."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = table.column("asks").combine_chunks()
        most = table.column("most").to_numpy()
        lists = [table.column(c).combine_chunks() for c in ("ats", "impacts")]
        offsets, (ats, impacts) = lists[0].offsets.to_numpy(), (x.values.to_numpy().astype(np.int64) for x in lists)
        row = np.repeat(np.arange(len(table)), pc.list_value_length(asks).to_numpy())
        asked = asks.flatten()
        names = asked.field(0).dictionary_encode()
        ids, weight, need = names.indices.to_numpy(), asked.field(1).to_numpy(), asked.field(2).to_numpy()
        leads = weight * most[row] >= need
        size = int(ats.max(initial=-1)) + 2  # the last one is for those without a key
        order = np.argsort(ids, kind="stable")
        out = []
        for own in np.split(order, np.flatnonzero(np.diff(ids[order])) + 1) if len(order) else ():
            if not leads[own].any():
                continue
            sums, seen = np.zeros(size, np.int64), np.zeros(size, bool)
            for i in own:
                part = slice(offsets[row[i]], offsets[row[i] + 1])
                np.add.at(sums, ats[part], weight[i] * impacts[part])
                if leads[i]:
                    seen[ats[part]] = True
            seen[-1] = False
            found = np.flatnonzero(seen)
            found = found[np.lexsort((found, -sums[found]))][:k]
            out.append((np.full(len(found), ids[own[0]]), found, sums[found]))
        query, at, score = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
        segment = np.full(len(at), table.column("segment")[0].as_py())
        return pa.table({"query": names.dictionary.take(pa.array(query)).cast(kind), "segment": segment, "at": at.astype(np.int32), "score": score})

    return run


def nearest_passages(index: PassageIndex, queries: DataFrame, query: str, text: str, k: int = 10) -> DataFrame:
    """The ``k`` best passages of each query: the query, ``rank``, key, ``passage_no`` and ``score``, above 0.

    Query ids are distinct; one without known terms has no row. Ties go to the smaller key and passage.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    asked = _asked(index, queries, query, text)
    bounds = stored(_bounds(index, asked, query, k), "bounds")
    decks = max(1, -(-bounds.select(query).distinct().count() // QUERIES))
    dealt = bounds.withColumn("deck", F.pmod(F.xxhash64(query), F.lit(decks)).cast("int"))
    asks = dealt.groupBy("term", "deck").agg(F.collect_list(F.struct(F.col(query).alias("query"), "weight", "need")).alias("asks"))
    asks = broadcast_if_small(stored(asks, "asks"), BROADCAST_TERMS)
    kind = queries.schema[query].dataType
    wanted = index.lists.join(asks, "term").select("segment", "deck", "most", "ats", "impacts", "asks")
    found = wanted.groupBy("segment", "deck").applyInArrow(_best_of_segment(k, to_arrow_type(kind)), f"query {kind.simpleString()}, segment LONG, at INT, score LONG")
    # The key tells equal scores apart, so the first pass keeps them all.
    near = found.where("score > 0").withColumn("_r", F.rank().over(W.partitionBy("query").orderBy(F.desc("score")))).where(F.col("_r") <= k)
    placed = near.join(index.places, ["segment", "at"]).select(F.col("query").alias(query), index.key, "passage_no", "score")
    order = F.row_number().over(W.partitionBy(query).orderBy(F.desc("score"), index.key, "passage_no"))
    return placed.withColumn("rank", order).where(F.col("rank") <= k)
