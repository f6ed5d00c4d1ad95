"""Lines that go to the ranges they are sorted in packed, and reviews that are shuffled narrow."""

import os

from pyspark.sql import functions as F

from suite import derived as D
from tidemark.session import scratch_path
from tidemark.sinks import text
from tidemark.sinks.text import write_sorted_text

NAN, INF = float("nan"), float("inf")


def _read(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in (n for n in names if n.endswith(".txt")):
            assert os.path.basename(folder) not in found
            found[os.path.basename(folder)] = open(os.path.join(folder, name)).read().split("\n")[:-1]
    return found


def _write(spark, rows, **named):
    path = scratch_path(spark, "ranges")
    names = {"f": F.when(F.col("number").isNotNull(), F.concat(F.lit("n"), "number")), "head": F.lit("first")}
    write_sorted_text(rows, path, names, 2, order=("a", "b"), **named)
    return _read(path)


def test_lines_are_not_shuffled_by_range(spark, monkeypatch):
    """Before, whole lines and their keys were shuffled as rows."""
    seen, dealt = [], type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda df, *a: seen.append(df.columns) or dealt(df, *a))
    rows = spark.range(5000).selectExpr("cast(id % 2 as int) number", "hash(id) a", "id b", "cast(id as string) line")
    found = _write(spark, rows, parts=9, sample=rows.where("id % 10 = 0"))
    assert seen == [["number", "a", "b"]]
    assert {k: len(v) for k, v in found.items()} == {"f=n0": 2501, "f=n1": 2501}


def test_order_is_that_of_spark(spark, monkeypatch):
    """Ranges are cut outside Spark: null comes first, not-a-number last, and text goes by its bytes. Keys that the sample lacks lie between."""
    monkeypatch.setattr(text, "HELD_BYTES", 1)  # several packs of a range per task
    a = [None, -INF, -1.5, -0.0, 0.0, 2.0, INF, NAN]
    b = [None, "", "B", "a", "é", "\U0001f600", "￿"]
    made = [(n, x, y, f"{n} {x} {y} {i}") for n in (None, 0, 1) for x in a for y in b for i in range(3)]
    rows = spark.createDataFrame(made, "number INT, a DOUBLE, b STRING, line STRING").repartition(5)
    wanted = {}
    for r in rows.orderBy("number", "a", "b").select("number", F.struct(F.col("a") + 0.0, "b").alias("k"), "line").collect():
        name = "f=__HIVE_DEFAULT_PARTITION__" if r.number is None else f"f=n{r.number}"
        wanted.setdefault(name, []).append((str(r.k[0]), r.k[1], r.line))
    for sample in (None, rows.where("a > 0 or b = 'a'"), rows.where("a is null"), rows.limit(0)):
        found = _write(spark, rows, parts=40, sample=sample)
        for name, lines in wanted.items():
            head, *got = found[name]
            keys = {line: (x, y) for x, y, line in lines}
            assert head == "first" and sorted(got) == sorted(keys)
            assert [keys[g] for g in got] == [(x, y) for x, y, _ in lines]


def test_packed_reviews_are_the_same(spark, tmp_path):
    """Nulls in every column, values below zero and letters that are no flag."""
    at = str(tmp_path)
    n = lambda c, m: F.when(F.col("id") % m > 0, c)
    i = F.col("id")
    spark.range(2000).select(
        n(i % 50, 41).alias("l_orderkey"), n(i % 20, 43).alias("l_partkey"), n(i % 400, 7).alias("l_suppkey"), n((i % 7).cast("int"), 11).alias("l_linenumber"),
        n((i % 55 - 3).cast("double"), 13).alias("l_quantity"), n(i * 1.25, 17).alias("l_extendedprice"), n((i % 9) / 100 - 0.02, 19).alias("l_discount"),
        n((i % 5) / 100 - 0.01, 23).alias("l_tax"), n(F.element_at(F.array(*map(F.lit, "ANR|")), (i % 4 + 1).cast("int")), 5).alias("l_returnflag"),
        n(F.when(i % 2 > 0, "F").otherwise("-"), 29).alias("l_linestatus"),
    ).write.parquet(f"{at}/lineitem.parquet")
    spark.range(60).select(
        i.alias("o_orderkey"), n(i % 9, 8).alias("o_custkey"), n(F.lit("5-LOW|x"), 9).alias("o_orderpriority"), n(F.lit("2020-01-02").cast("timestamp"), 10).alias("o_orderdate"),
    ).write.parquet(f"{at}/orders.parquet")
    spark.range(25).select(
        i.alias("p_partkey"), n(F.lit("a b"), 8).alias("p_name"), n(F.lit("B#1"), 9).alias("p_brand"), n(F.lit("T"), 7).alias("p_type"), n((i % 14).cast("int"), 5).alias("p_size"),
    ).write.parquet(f"{at}/part.parquet")
    plain, packed = D.reviews(spark, at), D.reviews(spark, at, packed=True)
    assert plain.count() > 1500 and plain.dtypes == packed.dtypes
    assert plain.exceptAll(packed).isEmpty() and packed.exceptAll(plain).isEmpty()
    assert plain.where("star_rating IS NULL").count() and plain.where("total_votes < 0").count()
