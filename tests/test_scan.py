import pytest
from pyspark.sql import functions as F

from tests.reviews import COLUMNS, KEPT, line, plain, text
from tidemark.operators.clean import clean, coerce
from tidemark.operators.rules import InRange, NotAbove, Present, keep
from tidemark.sources import tsv
from tidemark.sources.files import discover, list_files


@pytest.fixture
def edge(tmp_path):
    path = tmp_path / "amazon_reviews_us_Books_v1_00.tsv"
    path.write_text(text(), encoding="utf-8")
    return str(path)


def test_stage_counts(spark, edge):
    rows = coerce(tsv.scan_tsv(spark, edge))
    counts = [rows.count()]
    for rule in (InRange(), NotAbove(), Present()):
        rows = keep(rows, [rule])
        counts.append(rows.count())
    done = clean(coerce(tsv.scan_tsv(spark, edge)), tsv.ORDER)
    counts.append(done.count())
    assert counts == [13, 11, 9, 8, 6]
    assert sorted(r.customer_id for r in done.collect()) == sorted(KEPT)


def test_typed_values(spark, edge):
    rows = {r.customer_id: r for r in coerce(tsv.scan_tsv(spark, edge)).collect()}
    assert rows["1"].product_id == "0439784549"
    assert rows["1"].review_headline == '"q head' and rows["1"].review_body == 'body "x" back\\slash'
    assert rows["1"].verified_purchase is True and rows["3"].verified_purchase is None
    assert rows["2"].verified_purchase is False
    assert rows["4"].review_body is None and rows["10"].review_id is None
    assert rows["5"].review_date is None and rows["9"].review_date is None and rows["10"].review_date is None
    assert rows["12"].star_rating == 5.0 and rows["8"].star_rating is None and rows["9"].star_rating == 4.5
    assert rows["13"].review_body == "   " and rows["14"].helpful_votes is None
    assert rows["1"].source_file == "amazon_reviews_us_Books_v1_00.tsv"


def test_policies(spark, edge):
    strict = tsv.scan_tsv(spark, edge, policy=tsv.STRICT)
    assert {r.customer_id for r in strict.collect()} == {str(i) for i in range(1, 15)} - {"5", "6"}
    with pytest.raises(Exception, match="too many fields"):
        tsv.scan_tsv(spark, edge, policy=tsv.FAIL).collect()
    with pytest.raises(ValueError):
        tsv.scan_tsv(spark, edge, policy="other")
    assert [tuple(r) for r in tsv.line_counts(spark, [edge]).select("fit", "short", "long").collect()] == [(12, 1, 1)]


def test_bad_rows_reach_a_handler(spark, edge):
    bad = tsv.bad_rows(tsv.drop_blank(tsv.raw_lines(spark, [edge])), len(COLUMNS))
    assert [r.n_fields for r in bad.collect()] == [14]


def test_positions_over_many_splits(spark, tmp_path):
    """Lines keep their number when files are cut into many splits, packed or not."""
    rows = plain(4000)
    lines = [line(r) for r in rows]
    lines[1500:1500] = ["", "   "]  # blank lines count
    lines.insert(2500, line(rows[0]) + "\textra")  # a long line counts
    header = "\t".join(COLUMNS)
    lines.insert(10, header)  # a data line like the header stays
    big, small = tmp_path / "a.tsv", tmp_path / "b.tsv"
    big.write_text("\n".join([header, *lines]) + "\n")
    small.write_text("\n".join(["", header, *map(line, plain(5))]) + "\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        df = tsv.scan_tsv(spark, [str(big), str(small)], positions=True)
        assert df.rdd.getNumPartitions() > 10
        got = {(r.source_file, r.pos): r.customer_id for r in df.collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = {}
    for i, text_line in enumerate(lines):
        fields = text_line.split("\t")
        if text_line.strip() and len(fields) <= len(COLUMNS):
            want["a.tsv", i] = fields[1]
    want |= {("b.tsv", i): str(i) for i in range(5)}
    assert got == want
    assert got["a.tsv", 10] == "customer_id"


def test_chunks_without_rows_are_known(spark, tmp_path):
    (tmp_path / "a.tsv").write_text(text(plain(25)))
    (tmp_path / "empty.tsv").write_text("\t".join(COLUMNS) + "\n")
    paths = [str(tmp_path / "a.tsv"), str(tmp_path / "empty.tsv")]
    header = tsv.read_headers(spark, paths)[paths[0]]
    splits = tsv.split_table(tsv.raw_lines(spark, paths), header)
    got = sorted((r.source_file, r.chunk_idx) for r in tsv.chunks_of(splits, 10).collect())
    assert got == [("a.tsv", 0), ("a.tsv", 1), ("a.tsv", 2), ("empty.tsv", 0)]


def test_headers(spark, tmp_path):
    assert tsv.parse_header("\ufeffa\tb\ta\t") == ("a", "b", "a.1", "Unnamed: 3")
    (tmp_path / "one.tsv").write_text("a\tb\n1\t2\n")
    (tmp_path / "two.tsv").write_text("\n  \nb\tc\n3\t4\n")
    (tmp_path / "none.tsv").write_text("")
    paths = [str(tmp_path / f"{n}.tsv") for n in ("one", "two", "none")]
    headers = tsv.read_headers(spark, paths)
    assert headers[paths[2]].error and not headers[paths[0]].error
    with pytest.raises(ValueError, match="no columns"):
        tsv.scan_tsv(spark, paths)
    rows = tsv.scan_tsv(spark, paths[:2], positions=True).select("a", "b", "c").collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "2", None), (None, "3", "4")]


def test_blank_and_tab_lines(spark, tmp_path):
    """White space alone is skipped; a line of separators is a row of nulls."""
    (tmp_path / "a.tsv").write_text("a\tb\n1\t2\n\t\n   \n \t \n3\t4\n")
    rows = tsv.scan_tsv(spark, str(tmp_path / "a.tsv")).orderBy(*tsv.ORDER).select("a", "b").collect()
    assert [tuple(r) for r in rows] == [("1", "2"), (None, None), (" ", " "), ("3", "4")]


def test_discovery(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a b.tsv", "x.csv", "sub/deep.tsv"):
        (tmp_path / name).write_text("h\n")
    assert [r.source_file for r in discover(spark, str(tmp_path)).collect()] == ["a b.tsv"]
    assert list_files(spark, str(tmp_path), ".tsv").count() == 2
    with pytest.raises(FileNotFoundError):
        discover(spark, str(tmp_path), ".none")
    (tmp_path / "a b.tsv").write_text("h\tk\n1\t2\n")
    names = tsv.scan_tsv(spark, str(tmp_path / "a b.tsv")).select("source_file").collect()
    assert [r.source_file for r in names] == ["a b.tsv"]


def test_plain_read_stops_at_a_bad_row(spark, tmp_path):
    good, bad = tmp_path / "good.tsv", tmp_path / "bad.tsv"
    good.write_text('a\tb\n"x\ty"\t2\n')
    bad.write_text("a\tb\n1\t2\t3\n")
    assert [tuple(r) for r in tsv.read_plain(spark, str(good)).collect()] == [("x\ty", "2")]
    with pytest.raises(Exception, match="(?i)malformed"):
        tsv.read_plain(spark, str(bad)).collect()


def test_split_is_done_once(spark, edge):
    rows = keep(coerce(tsv.scan_tsv(spark, edge)), [InRange(), NotAbove(), Present()])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1
    assert not rows.filter(F.col("star_rating") <= 1).count()


def test_names_of_added_columns(spark, tmp_path):
    """Fields named like added columns keep their values or give way."""
    (tmp_path / "a.tsv").write_text("pos\tsource_file\tx\tx\n7\tmine\t1\t2\n")
    row = tsv.scan_tsv(spark, str(tmp_path / "a.tsv"), positions=True).collect()[0].asDict()
    assert (row["pos.1"], row["pos"], row["source_file"], row["x"], row["x.1"]) == ("7", 0, "a.tsv", "1", "2")
