"""Sorted text files that no task sorts."""

import os

from pyspark.sql import functions as F

from suite import derived as D
from tidemark.session import scratch_path, tune
from tidemark.sinks.tables import write_partitioned
from tidemark.sinks.text import write_sorted_text


def read(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in (n for n in names if n.endswith(".txt")):
            found.setdefault(os.path.basename(folder), []).append(open(os.path.join(folder, name), newline="").read())
    return found


def test_files_are_sorted(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 < 2, F.col("id") % 3).cast("int").alias("number"), F.xxhash64("id").alias("a"), F.col("id").alias("b"),
        F.concat(F.col("id").cast("string"), F.when(F.col("id") % 83 == 0, "\n").otherwise("")).alias("line"),
    )
    path = scratch_path(spark, "sorted")
    names = {"f": F.when(F.col("number").isNotNull(), F.concat(F.lit("n"), "number")), "head": F.lit("first")}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    write_sorted_text(rows.repartition(7), path, names, 2, order=("a", "b"))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    want = {}
    for r in rows.orderBy("a", "b").collect():
        want.setdefault("f=__HIVE_DEFAULT_PARTITION__" if r.number is None else f"f=n{r.number}", ["first"]).append(r.line)
    assert read(path) == {name: ["\n".join(lines) + "\n"] for name, lines in want.items()}


def test_dump_needs_no_task_for_a_file(spark, sf, monkeypatch):
    """The lines are sorted in ranges, more than there are files; before, a window sorted each file in one task."""
    monkeypatch.setattr(D, "_made", {})
    sorts, wrote = [], D.write_sorted_text

    def watched(lines, *args, **named):
        sorts.append(lines._jdf.queryExecution().executedPlan().toString())
        return wrote(lines, *args, **named)

    monkeypatch.setattr(D, "write_sorted_text", watched)
    found = read(D.dump(spark, sf))
    assert len(sorts) == 1 and "Window" not in sorts[0]
    assert all(len(files) == 1 for files in found.values())
    lines = [x for files in found.values() for x in files[0].split("\n") if x]
    assert len(lines) == len(found) + D.reviews(spark, sf).count()


def test_partitions_are_written_without_a_sort(spark, monkeypatch):
    """A task of a rebalanced table has few partitions; before, all its rows were sorted by partition."""
    path, seen = scratch_path(spark, "unsorted"), []
    writer = type(spark.range(1).write)
    wrote = writer.parquet

    def watched(self, *args, **named):
        seen.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        return wrote(self, *args, **named)

    monkeypatch.setattr(writer, "parquet", watched)
    rows = spark.range(1000).selectExpr("id", "id % 30 AS part")
    write_partitioned(rows, path, ["part"])
    assert seen == ["8"] and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("id", "part").collect()) == [(i, i % 30) for i in range(1000)]


def test_ranges_follow_the_rows(spark, monkeypatch):
    """A session of few partitions sorts no larger ranges; before, there were no more ranges than it had partitions."""
    rows = spark.range(4000).select(F.lit(0).alias("number"), F.col("id").alias("a"), F.col("id").cast("string").alias("line"))
    path, parts = scratch_path(spark, "ranges"), int(spark.conf.get("spark.sql.shuffle.partitions")) + 5
    seen = []
    dealt = type(rows).repartitionByRange

    def watched(self, *args):
        seen.append(args[0])
        return dealt(self, *args)

    monkeypatch.setattr(type(rows), "repartitionByRange", watched)
    write_sorted_text(rows, path, {"f": F.lit("one"), "head": F.lit("first")}, 1, order=("a",), parts=parts)
    assert seen == [parts]
    assert read(path) == {"f=one": ["\n".join(["first", *map(str, range(4000))]) + "\n"]}


def test_joins_of_reviews_sort_nothing(spark, sf):
    """Where no side is broadcast, the side with small partitions is hashed; before, both sides were sorted."""
    import __spark_entry__ as entry

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = entry.queries()["null_tokens"](spark, sf)
        assert len(rows.collect()) == D.reviews(spark, sf).count()
        plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        tune(spark)
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan
