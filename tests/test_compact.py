"""Compaction that does not shuffle what lies in files."""

import os

from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sinks.tables import compact


def _files(path):
    return [n for _, _, names in os.walk(path) for n in names if n.endswith(".parquet")]


def test_stored_rows_are_not_shuffled(spark, monkeypatch):
    """Before, all rows were shuffled to be put into larger files."""
    rows = spark.range(5000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("part"), F.lit(None).cast("string").alias("none"))
    path, out = scratch_path(spark, "small"), scratch_path(spark, "large")
    rows.repartition(40).write.partitionBy("part").parquet(path)
    dealt, hint = [], type(rows).hint
    monkeypatch.setattr(type(rows), "hint", lambda df, name, *a: dealt.append(name) or hint(df, name, *a))
    stored = spark.read.parquet(path)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = [spark.conf.get(k, None) for k in keys]
    compact(stored.select("part", "id", "none"), out)
    assert not dealt and [spark.conf.get(k, None) for k in keys] == before
    assert len(_files(path)) > 100 and len(_files(out)) == 1
    found = spark.read.parquet(out)
    assert found.columns == ["part", "id", "none"]
    assert sorted(found.collect(), key=lambda r: r.id) == sorted(stored.select("part", "id", "none").collect(), key=lambda r: r.id)


def test_large_files_stay_apart(spark):
    """The advisory size holds for files that are read as they are, too."""
    path, out = scratch_path(spark, "small"), scratch_path(spark, "large")
    spark.range(200_000).select(F.xxhash64("id").alias("x")).repartition(20).write.parquet(path)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "400k")
    try:
        compact(spark.read.parquet(path), out)
    finally:
        spark.conf.set(key, before)
    assert 3 <= len(_files(out)) <= 10
    assert spark.read.parquet(out).distinct().count() == 200_000


def test_other_rows_are_shuffled(spark, monkeypatch):
    """Rows that are filtered or joined may be few in many tasks."""
    path, out = scratch_path(spark, "small"), scratch_path(spark, "large")
    spark.range(1000).repartition(20).write.parquet(path)
    for rows in (spark.read.parquet(path).where("id % 2 = 0"), spark.range(500, numPartitions=20), spark.createDataFrame([], "id BIGINT")):
        n = rows.count()
        compact(rows, out)
        assert len(_files(out)) <= 1 and spark.read.schema("id BIGINT").parquet(out).count() == n
