"""Wide rows that are not shuffled or sorted for what is decided elsewhere."""

import pytest
from pyspark.sql import functions as F

from suite import derived as D
from suite.queries import QUERIES
from tidemark.functions import learned
from tidemark.plans.ingest import PAGE, _marked
from tidemark.sources.quoted import quoted_lines, split_states


@pytest.mark.parametrize("place", [("pos",), ("_block", "pos")])
def test_rows_are_marked_by_bitmaps(spark, place):
    """Before, the rows were joined with the places of those left out, by shuffle if these were many."""
    at = [0, 1, 7, 8, PAGE - 1, PAGE, PAGE + 1, 5 * PAGE + 3, 1 << 40]
    rows = spark.createDataFrame([(f, b, p) for f in ("a", "b") for b in (0, 64) for p in at], "file_id STRING, _block BIGINT, pos BIGINT")
    rows = rows.withColumn("_at", F.struct(*place))
    later = rows.where("file_id = 'a' AND pos % 2 = 1 AND _block = 0").select("file_id", "_at")
    lost = rows.where(f"file_id = 'b' AND pos >= {PAGE} AND _block = 0").select("file_id", "_at")
    marked = _marked(rows, {"later": later, "lost": lost}, place)
    whole = len(place) == 1
    for r in marked.collect():
        of_block = whole or r._block == 0
        assert r.later == (r.file_id == "a" and r.pos % 2 == 1 and of_block)
        assert r.lost == (r.file_id == "b" and r.pos >= PAGE and of_block)
    assert marked.count() == rows.count() and "_at" not in marked.columns
    assert "Exchange hashpartitioning" not in marked._jdf.queryExecution().executedPlan().toString()


def test_terms_of_a_text_stay(spark):
    """Before, every term of every text was shuffled to the weights."""
    rows = spark.createDataFrame([(1, "good fine day", 5), (2, "bad day", 1), (3, "good fine", 5), (4, "bad bad", 1)], "id INT, text STRING, stars INT")
    model = learned.fit(rows, "id", "text", "stars")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = learned.scores(rows, "id", "text", model)
        assert "hashpartitioning(term" not in found._jdf.queryExecution().executedPlan().toString()
        assert {r.id: r.score > 0 for r in found.collect()} == {1: True, 2: False, 3: True, 4: False}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name, folder", [("scan_first_n_files", "/parts-"), ("unreadable_files", "/probed-")])
def test_parts_are_written_without_a_sort(spark, sf, monkeypatch, name, folder):
    seen = []
    writer = type(spark.range(1).write)
    wrote = writer.parquet

    def watched(self, path, *args, **named):
        seen.extend([spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")] if folder in path else [])
        return wrote(self, path, *args, **named)

    monkeypatch.setattr(writer, "parquet", watched)
    monkeypatch.setattr(D, "_made", {k: v for k, v in D._made.items() if k[2] not in ("parts", "probed")})
    assert QUERIES[name](spark, sf).count()
    assert seen == ["8"]


def test_only_splits_with_an_open_field_are_cut(spark, tmp_path):
    """Before, pieces were looked for in every split, so all lines went to Python once more."""
    (tmp_path / "plain.csv").write_text("k\ta\n" + "1\t\"x y\"\n" * 50)
    (tmp_path / "open.csv").write_text("k\ta\n1\t\"" + "x\n" * 50 + "\"\n")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        for n, v in zip(names, ("60", "1")):
            spark.conf.set(n, v)
        for name, cut in (("plain", {False}), ("open", {True})):
            states = split_states(quoted_lines(spark, [str(tmp_path / f"{name}.csv")]), "\t").collect()
            assert len(states) > 1 and {r.cut for r in states} == cut
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


def test_rejects_are_written_where_they_lie(spark, tmp_path, monkeypatch):
    """Before, rejected rows were all shuffled by file to be written."""
    from tidemark.plans import ingest
    from tidemark.sinks import tables

    dealt, hint = [], tables.spread
    monkeypatch.setattr(tables, "spread", lambda df, columns: dealt.append(df.columns) or hint(df, columns))
    (tmp_path / "in").mkdir()
    head = ["customer_id", "review_id", "product_id", "star_rating", "helpful_votes", "total_votes", "review_body", "review_date"]
    lines = ["\t".join(head), "\t".join("1 R1 2 5 0 0 good 2020-01-02".split()), "\t".join("1 R1 2 9 0 0 good 2020-01-02".split())]
    (tmp_path / "in" / "amazon_reviews_us_Toys_v1_00.tsv").write_text("\n".join(lines) + "\n")
    config = ingest.IngestConfig(root=str(tmp_path / "lake"), run_id="r", rejects=ingest.ALL, required=("review_id",))
    ingest.ingest(spark, str(tmp_path / "in"), config)
    assert spark.read.parquet(config.path("quarantine")).count() == 1
    assert not any("record" in columns for columns in dealt)
