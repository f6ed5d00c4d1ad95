import gzip
import json
import os
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.reviews import COLUMNS, KEPT, plain, text
from tidemark.plans.ingest import ALL, FILES, WHOLE, IngestConfig, ingest, show_summary
from tidemark.sinks import tables as sinks
from tidemark.sources.parquet import read_category, read_dataset, read_first_files
from tidemark.state import manifest
from tidemark.streaming.incremental import start_ingest

AS_OF = datetime(2024, 1, 9, 10, 11, 12)


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "amazon_reviews_us_Books_v1_00.tsv").write_text(text())
    (folder / "amazon_reviews_us_Books_v1_01.tsv").write_text(text(plain(25)))
    (folder / "other.tsv").write_text(text(plain(5, 100)))
    (folder / "amazon_reviews_us_Toys_v1_00.tsv").write_text(text(plain(4, 200), [c for c in COLUMNS if c != "review_body"] + ["z"]))
    (folder / "amazon_reviews_us_PC_v1_00.tsv").write_text("\t".join(COLUMNS) + "\n")
    return folder


@pytest.fixture
def config(tmp_path):
    return IngestConfig(root=str(tmp_path / "out"), run_id="r1", as_of=AS_OF, chunk_rows=10, rejects=ALL)


def table(spark, config, name):
    return spark.read.parquet(config.path(name))


def customer(record):
    """The customer of a record of fields, or of a line that was skipped."""
    return record["customer_id"] if "customer_id" in record else record["line"].split("\t")[1]


def test_run(spark, source, config):
    result = ingest(spark, str(source), config)
    assert result.failed == {"amazon_reviews_us_Toys_v1_00.tsv": "missing columns: ['review_body']"}
    assert len(result.processed) == 4

    stored = read_dataset(spark, config.clean_path)
    assert stored.filter("source_file LIKE '%Books_v1_00%'").count() == len(KEPT)
    counts = {r.source_file: r["count"] for r in stored.groupBy("source_file").count().collect()}
    assert counts == {
        "amazon_reviews_us_Books_v1_00.tsv": 6, "amazon_reviews_us_Books_v1_01.tsv": 25, "other.tsv": 5,
    }
    places = {(r.year, r.month, r.category) for r in stored.select("year", "month", "category").distinct().collect()}
    assert places == {(2024, "01", "Books"), (2024, "01", "Unknown")}
    assert stored.select("ingest_time").distinct().collect()[0][0] == AS_OF
    assert stored.filter("source_file LIKE '%v1_01%'").select("batch_id").distinct().count() == 3

    lineage = {(r.source_file, r.chunk_idx): r for r in table(spark, config, "state/lineage").collect()}
    assert lineage["amazon_reviews_us_Books_v1_01.tsv", 2].row_count == 5
    assert lineage["amazon_reviews_us_Books_v1_01.tsv", 2].output_parquet == "bronze/reviews/year=2024/month=01/category=Books/part_00002.parquet"
    assert lineage["amazon_reviews_us_PC_v1_00.tsv", 0].row_count == 0

    # Clean rows and rejects make up the input.
    rejects = table(spark, config, "quarantine")
    by_file = {}
    for r in rejects.collect():
        by_file.setdefault(r.source_file, []).append((r.reason, customer(json.loads(r.record))))
    assert sorted(by_file["amazon_reviews_us_Books_v1_00.tsv"]) == sorted(
        [("rating", "2"), ("rating", "8"), ("votes", "3"), ("votes", "14"), ("null_text", "4"), ("duplicate", "7"), ("duplicate", "11"), ("too_many_fields", "6")]
    )
    assert len(by_file["amazon_reviews_us_Toys_v1_00.tsv"]) == 4
    # A rejected row keeps the text it was read with.
    bad = [json.loads(r.record) for r in rejects.filter("reason = 'rating'").collect()]
    assert {"abc", "1"} == {r["star_rating"] for r in bad}

    metrics = table(spark, config, "state/metrics").collect()[0]
    assert (metrics.processed_files, metrics.processed_rows, metrics.failed_rows) == (4, 36, 4)
    assert metrics.processed_chunks == 2 + 3 + 1 + 1 and metrics.duration_seconds > 0
    show_summary(spark, config)

    # A second run takes only what failed or is new, and changes no row.
    before = sorted(map(str, stored.collect()))
    config = replace(config, rejects=FILES)
    again = ingest(spark, str(source), replace(config, run_id="r2"))
    assert again.processed == () and set(again.failed) == set(result.failed)
    assert sorted(map(str, read_dataset(spark, config.clean_path).collect())) == before
    assert not manifest.dataset_complete(manifest.load(spark, config.path("state/manifest")))

    # Repaired file: taken, and the dataset is complete.
    (source / "amazon_reviews_us_Toys_v1_00.tsv").write_text(text(plain(4, 200)))
    done = ingest(spark, str(source), replace(config, run_id="r3", stop_when_complete=True))
    assert done.processed == ("amazon_reviews_us_Toys_v1_00.tsv",) and not done.failed
    assert read_dataset(spark, config.clean_path).count() == 40
    assert ingest(spark, str(source), replace(config, run_id="r4", stop_when_complete=True)).processed == ()

    # Reset: the file is taken again and replaces itself.
    manifest.reset(spark, config.path("state/manifest"), ["other.tsv"], AS_OF + timedelta(days=1))
    redone = ingest(spark, str(source), replace(config, run_id="r5", as_of=AS_OF + timedelta(days=2)))
    assert redone.processed == ("other.tsv",) and read_dataset(spark, config.clean_path).count() == 40


def test_replayed_run_adds_nothing(spark, source, config, tmp_path):
    ingest(spark, str(source), config)
    names = ("quarantine", "state/lineage")
    before = {n: table(spark, config, n).count() for n in names}
    rows = read_dataset(spark, config.clean_path).count()
    manifest.reset(spark, config.path("state/manifest"), [f.name for f in source.iterdir()], AS_OF + timedelta(seconds=1))
    ingest(spark, str(source), config)
    assert {n: table(spark, config, n).count() for n in names} == before
    assert read_dataset(spark, config.clean_path).count() == rows


def test_chunk_scope(spark, tmp_path, config):
    folder = tmp_path / "dups"
    folder.mkdir()
    rows = plain(10) + plain(10)
    (folder / "a.tsv").write_text(text(rows))
    ingest(spark, str(folder), replace(config, dedup_scope="chunk", rejects=FILES))
    assert read_dataset(spark, config.clean_path).count() == 20
    with pytest.raises(ValueError):
        ingest(spark, str(folder), replace(config, root=config.root + "2", dedup_scope="x"))


def test_unreadable_file_does_not_stop_the_others(spark, tmp_path, config):
    folder = tmp_path / "gz"
    folder.mkdir()
    (folder / "good.tsv.gz").write_bytes(gzip.compress(text(plain(12), (*COLUMNS[:-1], "review_date", "pos")).encode()))
    (folder / "bad.tsv.gz").write_bytes(b"this is no archive")
    (folder / "empty.tsv.gz").write_bytes(gzip.compress(b""))
    result = ingest(spark, str(folder), replace(config, suffix=".tsv.gz"))
    assert result.processed == ("good.tsv.gz",) and set(result.failed) == {"bad.tsv.gz", "empty.tsv.gz"}
    assert read_dataset(spark, config.clean_path).count() == 12
    failures = {r.source_file: r.error_message for r in table(spark, config, "state/failures").collect()}
    assert failures["bad.tsv.gz"].startswith("cannot read")
    assert table(spark, config, "state/metrics").collect()[0].failed_rows == 0


def test_whole_files_read_once(spark, source, config):
    """The single-pass run keeps the same rows."""
    ingest(spark, str(source), replace(config, chunks=WHOLE))
    stored = read_dataset(spark, config.clean_path)
    assert stored.count() == 36
    assert stored.filter("source_file LIKE '%Books_v1_00%'").count() == len(KEPT)
    lineage = table(spark, config, "state/lineage")
    assert lineage.agg(F.sum("row_count")).collect()[0][0] == 36
    assert lineage.select("source_file").distinct().count() == 4


def test_stream(spark, source, config):
    (source / "amazon_reviews_us_Toys_v1_00.tsv").write_text(text(plain(4, 200)))
    batches = []
    start_ingest(spark, str(source), config, after=batches.append).awaitTermination()
    assert read_dataset(spark, config.clean_path).count() == 40 and batches == [0]
    start_ingest(spark, str(source), config, after=batches.append).awaitTermination()
    assert batches == [0]
    (source / "new.tsv").write_text(text(plain(3, 500)))
    start_ingest(spark, str(source), config, after=batches.append).awaitTermination()
    assert batches == [0, 1] and read_dataset(spark, config.clean_path).count() == 43


def parts(folder, *bodies):
    """Files of one logical name, in folders of their own."""
    for i, body in enumerate(bodies):
        (folder / f"dump=a.tsv{'' if i < 2 else i}" / f"p{i}").mkdir(parents=True)
        (folder / f"dump=a.tsv{'' if i < 2 else i}" / f"p{i}" / "part.txt").write_text(body)


PARTED = {"suffix": ".txt", "recursive": True, "name_pattern": r"dump=([^/]+)/"}


@pytest.mark.parametrize("max_files", [1, 10])
def test_stream_takes_all_parts_once(spark, tmp_path, config, max_files):
    parts(tmp_path / "in", text(plain(5)), text(plain(5, 5)), text(plain(5) + plain(2, 50)))
    old = tmp_path / "in" / "dump=a.tsv" / "p0" / "part.txt"
    os.utime(old, (1_000_000, 1_000_000))
    config = replace(config, **PARTED)
    start_ingest(spark, str(tmp_path / "in"), config, max_files=max_files).awaitTermination()
    stored = read_dataset(spark, config.clean_path)
    # The third file repeats the keys of the first.
    assert stored.count() == 12 and stored.select("review_id").distinct().count() == 12
    ingest(spark, str(tmp_path / "in"), replace(config, root=config.root + "-batch"))
    batch = read_dataset(spark, config.root + "-batch/bronze/reviews")
    key = ("source_file", "review_id", "customer_id")
    assert sorted(map(tuple, batch.select(*key).collect())) == sorted(map(tuple, stored.select(*key).collect()))


def test_later_part_and_old_file_are_taken(spark, tmp_path, config):
    folder, config = tmp_path / "in", replace(config, **PARTED)
    parts(folder, text(plain(5)))
    assert ingest(spark, str(folder), config).processed == ("a.tsv",)
    (folder / "dump=a.tsv" / "later").mkdir()
    (folder / "dump=a.tsv" / "later" / "part.txt").write_text(text(plain(8)))
    os.utime(folder / "dump=a.tsv" / "later" / "part.txt", (1_000_000, 1_000_000))
    # The same run id: the side tables keep what the first call wrote.
    assert ingest(spark, str(folder), config).processed == ("a.tsv",)
    assert read_dataset(spark, config.clean_path).count() == 8
    assert table(spark, config, "quarantine").filter("reason = 'duplicate'").count() == 5
    assert table(spark, config, "state/lineage").agg(F.sum("row_count")).first()[0] == 8
    metrics = table(spark, config, "state/metrics").first()
    assert (metrics.processed_files, metrics.processed_rows) == (2, 8)


def test_failed_file_of_a_stream_is_tried_again(spark, tmp_path, config):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "good.tsv").write_text(text(plain(5)))
    (folder / "bad.tsv").write_text(text(plain(5, 100), [c for c in COLUMNS if c != "review_body"] + ["z"]))
    assert set(start_ingest(spark, str(folder), config).awaitTermination().failed) == {"bad.tsv"}
    (folder / "bad.tsv").write_text(text(plain(5, 100)))
    assert start_ingest(spark, str(folder), config).awaitTermination().processed == ("bad.tsv",)
    assert read_dataset(spark, config.clean_path).count() == 10


def test_rerun_replaces_a_file_by_nothing_and_in_other_months(spark, tmp_path, config):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a[1].tsv").write_text(text(plain(5)))
    (folder / "b.tsv").write_text(text(plain(3, 100)))
    ingest(spark, str(folder), config)
    # A reset at the same logical time holds, and a rerun may have an earlier one.
    manifest.reset(spark, config.path("state/manifest"), ["a[1].tsv"], AS_OF)
    ingest(spark, str(folder), replace(config, as_of=AS_OF - timedelta(days=60)))
    stored = read_dataset(spark, config.clean_path)
    assert stored.count() == 8 and {r.month for r in stored.select("month").distinct().collect()} == {"01", "11"}
    assert ingest(spark, str(folder), config).processed == ()
    (folder / "a[1].tsv").write_text(text([(*r[:2], "1", *r[3:]) for r in plain(5)]))
    manifest.reset(spark, config.path("state/manifest"), ["a[1].tsv"], AS_OF)
    ingest(spark, str(folder), config)
    assert read_dataset(spark, config.clean_path).count() == 3
    assert table(spark, config, "quarantine").filter("reason = 'rating'").count() == 5


def test_date_formats(spark, tmp_path, config):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.tsv").write_text(text([(*r[:-1], "08/31/2015") for r in plain(2)]))
    ingest(spark, str(folder), replace(config, date_formats=("yyyy-MM-dd", "MM/dd/yyyy")))
    assert {str(r[0]) for r in read_dataset(spark, config.clean_path).select("review_date").collect()} == {"2015-08-31 00:00:00"}


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "m")
    assert manifest.load(spark, path).count() == 0
    at = AS_OF
    manifest.mark_processed(spark, path, ["a", "b"], at)
    manifest.append(manifest.marks(spark.createDataFrame([("c",)], "source_file STRING"), at, False), path)
    manifest.reset(spark, path, ["b"], at + timedelta(seconds=1))
    events = manifest.load(spark, path)
    assert sorted(r.file_name for r in manifest.known_files(events).collect()) == ["a", "c"]
    assert manifest.is_processed(events, "a") and not manifest.is_processed(events, "b")
    files = spark.createDataFrame([(n,) for n in "abcd"], "source_file STRING")
    assert sorted(r.source_file for r in manifest.pending(files, events).collect()) == ["b", "c", "d"]


def test_unreadable_state_is_an_error(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        manifest.load(spark, str(tmp_path / "m")).collect()


def test_json_state(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"a.tsv": {"processed": True}, "b.tsv": {}}, indent=4))
    got = {r.file_name: r.processed for r in manifest.read_manifest_json(spark, str(tmp_path / "m.json"), AS_OF).collect()}
    assert got == {"a.tsv": True, "b.tsv": False}
    assert manifest.read_manifest_json(spark, str(tmp_path / "no.json"), AS_OF).count() == 0
    record = {"source_file": "a", "output_parquet": "o", "category": "c", "row_count": 3, "chunk_idx": 0, "processed_at": "2024-01-09T10:11:12+00:00"}
    (tmp_path / "l.json").write_text(json.dumps([record, record], indent=4))
    rows = manifest.read_lineage_json(spark, str(tmp_path / "l.json")).collect()
    assert [(r.row_count, r.processed_at) for r in rows] == [(3, AS_OF)] * 2
    assert manifest.read_lineage_json(spark, str(tmp_path / "no.json")).count() == 0


def test_dynamic_overwrite_and_reads(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(1000).select(
        "id", F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("category"), F.lit(0).alias("chunk_idx")
    )
    sinks.write_partitioned(rows, root, ["category"])
    sinks.write_partitioned(rows.filter("category = 'A' AND id < 30"), root, ["category"])
    counts = {r.category: r["count"] for r in read_dataset(spark, root).groupBy("category").count().collect()}
    assert counts == {"A": 10, "B": 666}
    plan = read_category(spark, root, "A")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan
    with pytest.raises(FileNotFoundError):
        read_category(spark, root, "C")
    (tmp_path / "t" / "category=A" / "aa.parquet").write_text("garbage")
    assert read_first_files(spark, root, 5).count() > 0
    sample = str(tmp_path / "s")
    sinks.write_sample(rows.filter("category = 'A'"), sample)
    sinks.write_sample(rows.withColumn("id", F.lit(-1)), sample, only_absent=True)
    kept = {(r.category, r.n) for r in read_dataset(spark, sample).groupBy("category").agg(F.min("id").alias("n")).collect()}
    assert kept == {("A", 0), ("B", -1)}
    sinks.compact(rows, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 1000
    docs = rows.select(F.lit("f").alias("source_file"), F.lit("r").alias("reason"), F.col("id").cast("string").alias("record"))
    sinks.write_documents(docs, str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d")).count() == 1000


def test_large_partition_is_split_over_files(spark, tmp_path):
    """The rows of one category come from many tasks' worth of data and go to several files."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100000")
        rows = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"), F.lit("A").alias("category"))
        sinks.write_partitioned(rows, str(tmp_path / "t"), ["category"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(list((tmp_path / "t" / "category=A").glob("*.parquet"))) > 4
