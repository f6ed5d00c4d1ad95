from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from tests.reviews import plain, text
from tidemark.operators.dates import chunk_formats, infer_dates
from tidemark.plans.ingest import IngestConfig, ingest
from tidemark.sources.parquet import probe_files, read_dataset


def test_first_readable_value_of_a_chunk_decides(spark):
    rows = [
        ("a", 0, None), ("a", 1, "notadate"), ("a", 2, "08/07/2015"), ("a", 3, "2015-08-31"), ("a", 4, "13/01/2015"), ("a", 5, "12/31/2015"),
        ("b", 0, "2015-08-31"), ("b", 1, "08/31/2015"), ("c", 0, "x"), ("c", 1, None), (None, 0, "31.12.2014"), (None, 1, "01.02.2015"),
    ]
    frame = spark.createDataFrame(rows, "chunk string, n int, day string").repartition(3)
    got = {(r.chunk, r.n): r.day and str(r.day)[:10] for r in infer_dates(frame.where("chunk is not null"), ("chunk",), ("n",), ["day"]).collect()}
    assert got == {
        ("a", 0): None, ("a", 1): None, ("a", 2): "2015-08-07", ("a", 3): None, ("a", 4): None, ("a", 5): "2015-12-31",
        ("b", 0): "2015-08-31", ("b", 1): None, ("c", 0): None, ("c", 1): None,
    }
    formats = {r.chunk: r._f_day for r in chunk_formats(frame, ("chunk",), ("n",), ["day"]).collect()}
    assert formats == {"a": 1, "b": 0, "c": None, None: 2}
    assert infer_dates(frame.limit(0), ("chunk",), ("n",), ["day"]).count() == 0


def test_a_run_infers_dates_by_chunk(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.tsv").write_text(text([(*r[:-1], "08/31/2015") for r in plain(3)]))
    (folder / "b.tsv").write_text(text([(*r[:-1], d) for r, d in zip(plain(4, 10), ("2015-01-02", "08/31/2015", "", "2015-02-03"))]))
    config = IngestConfig(
        root=str(tmp_path / "out"), run_id="r", as_of=datetime(2024, 1, 1), chunk_rows=10, infer_dates=True, date_formats=("yyyy-MM-dd", "MM/dd/yyyy"),
    )
    ingest(spark, str(folder), config)
    got = sorted((r.source_file, str(r.review_date)[:10]) for r in read_dataset(spark, config.clean_path).collect())
    assert got == [("a.tsv", "2015-08-31")] * 3 + [("b.tsv", "2015-01-02"), ("b.tsv", "2015-02-03"), ("b.tsv", "None"), ("b.tsv", "None")]
    assert replace(config, infer_dates=False).date_formats == config.date_formats


def test_files_without_a_footer_are_told(spark, tmp_path):
    root = tmp_path / "t"
    spark.range(100).select("id", (F.col("id") % 3).alias("part")).repartition(2).write.partitionBy("part").parquet(str(root))
    spark.range(10).where("id < 0").coalesce(1).write.parquet(str(root / "part=9"))
    (root / "part=0" / "torn.parquet").write_bytes(next((root / "part=0").glob("*.parquet")).read_bytes()[:-9])
    found = {r.path: (r.n_rows, r.readable, r.error) for r in probe_files(spark, str(root)).collect()}
    (torn,) = [p for p in found if p.endswith("torn.parquet")]
    assert found.pop(torn) == (0, False, "no footer")
    assert sum(n for n, _, _ in found.values()) == 100 and all(ok and error is None for _, ok, error in found.values())
    assert 0 in {n for n, _, _ in found.values()}
