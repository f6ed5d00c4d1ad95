from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.functions.sentiment import with_model, with_sentiment
from tidemark.operators import observe
from tidemark.operators.dedup import first_per_key, flag_duplicates
from tidemark.operators.quality import MissingColumns, check_category, check_columns, profile, unknown_categories
from tidemark.operators.ranks import with_rank
from tidemark.operators.rules import InRange, NotAbove, Present, keep, with_reason
from tidemark.operators.tables import head, union_parts
from tidemark.plans import products, retrieval
from tidemark.sources.categories import default_categories, read_categories
from tidemark.sources.jdbc import JdbcTarget

AT = datetime(2024, 2, 3, 4, 5, 6)


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_numbers(spark):
    texts = ["5", " 5 ", "4.5", "1e1", "+5", "5.", ".5", "5d", "5f", "NAN", "1_0", "0x10", "", "abc", None, "-3", "1e400"]
    want = [5.0, 5.0, 4.5, 10.0, 5.0, 5.0, 0.5, None, None, None, None, None, None, None, None, -3.0, float("inf")]
    assert column(spark, ["1e250", "9" * 300], S.safe_number) == [1e250, float("9" * 300)]
    assert column(spark, texts, S.safe_number) == want
    assert column(spark, ["inf", "-Infinity"], S.safe_number) == [float("inf"), float("-inf")]


def test_flags_dates_tokens(spark):
    assert column(spark, ["Y", "N", "y", "", None], S.yes_no) == [True, False, None, None, None]
    dates = column(spark, ["2015-08-31", "08/31/2015", "2015-8-1", "2015", "x", None], S.safe_timestamp)
    assert dates == [datetime(2015, 8, 31)] + [None] * 5
    both = column(spark, ["08/31/2015"], lambda c: S.safe_timestamp(c, ("yyyy-MM-dd", "MM/dd/yyyy")))
    assert both == [datetime(2015, 8, 31)]
    assert column(spark, ["NA", "na", "None", "x", " "], S.null_if_token) == [None, "na", None, "x", " "]


def test_names(spark):
    files = ["amazon_reviews_us_Books_v1_00.tsv", "amazon_reviews_us_A_v1_v2.tsv", "other.tsv"]
    assert column(spark, files, S.category_of) == ["Books", "A_v1", "Unknown"]
    assert column(spark, [0, 123456], S.part_name, "int") == ["part_00000.parquet", "part_123456.parquet"]
    assert column(spark, ["a/b/c.tsv", "c"], S.base_name) == ["c.tsv", "c"]
    assert column(spark, [0, 199_999, 200_000], S.chunk_of, "long") == [0, 0, 1]


def test_nan_and_null_fail_rules(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1.5, 1.0, 2.0), (nan, 1.0, 2.0), (2.0, nan, 2.0), (2.0, 1.0, nan), (2.0, nan, nan), (None, 1.0, 2.0), (2.0, 1.0, inf)]
    df = spark.createDataFrame(rows, "star_rating DOUBLE, helpful_votes DOUBLE, total_votes DOUBLE")
    got = keep(df, [InRange(), NotAbove(), Present()]).collect()
    assert [tuple(r) for r in got] == [(1.5, 1.0, 2.0), (2.0, 1.0, inf)]
    one_star = spark.createDataFrame([(1.0,)], "star_rating DOUBLE")
    assert keep(one_star).count() == 0 and keep(one_star, [InRange(low_inclusive=True)]).count() == 1


def test_reasons_and_kept_rows_make_the_input(spark, sf):
    from suite import derived

    rows = derived.typed(spark, sf)
    reasons = with_reason(rows)
    assert reasons.filter("reason IS NULL").count() == keep(rows).count() == 2339
    flagged = flag_duplicates(keep(rows), ["review_id"], ["seq", "product_id", "customer_id"])
    assert flagged.count() == 2339 and flagged.filter("NOT is_duplicate").count() == 2088


def test_hot_key_does_not_gather(spark):
    """A third of the rows have no key; each task sends one of them."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("k"), "id"
    )
    out = first_per_key(df, ["k"], ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    want = {}
    for r in df.collect():
        want[r.k] = min(want.get(r.k, r.id), r.id)
    assert {r.k: r.id for r in out.collect()} == want
    flagged = flag_duplicates(df, ["k"], ["id"])
    assert flagged.count() == 30_000
    assert {r.k: r.id for r in flagged.filter("NOT is_duplicate").collect()} == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), min_size=1, max_size=30))
def test_dedup_like_a_loop(spark, rows):
    df = spark.createDataFrame([(i, k, c) for i, (k, c) in enumerate(rows)], "i INT, k STRING, c INT")
    seen, want = set(), []
    for i, (k, c) in enumerate(rows):
        if (k, c) not in seen:
            seen.add((k, c))
            want.append(i)
    assert sorted(r.i for r in first_per_key(df, ["k"], ["i"], scope=["c"]).collect()) == want


def test_ranks_like_row_number(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
        (F.col("id") * 7919 % 5000).alias("v"),
    )
    got = {(r.g, r.v): r.rank for r in with_rank(df, "g", [F.desc("v")]).collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault(r.g, []).append(r.v)
    want = {(g, v): i for g, vs in groups.items() for i, v in enumerate(sorted(vs, reverse=True), 1)}
    assert got == want


def test_suggestions_like_brute_force(spark):
    import random

    rnd = random.Random(7)
    rows = [(f"c{rnd.randrange(12)}", rnd.choice("XY"), f"p{rnd.randrange(15)}", float(rnd.randint(2, 5))) for _ in range(300)]
    rows += [("greedy", "X", f"p{i}", 5.0) for i in range(13)]
    rows = [(c, g, g + p, s, True) for c, g, p, s in rows]
    df = spark.createDataFrame(
        rows, "customer_id STRING, product_category STRING, product_id STRING, star_rating DOUBLE, verified_purchase BOOLEAN"
    )
    ranked = {}
    for r in products.damped(products.product_ratings(df)).collect():
        ranked.setdefault(r.product_category, []).append((-r.damped_rating, -r.n_reviews, r.product_id))
    want = set()
    for customer in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == customer]
        stats = {}
        for _, g, _, s, _ in own:
            stats.setdefault(g, []).append(s)
        best = min(stats, key=lambda g: (-len(stats[g]), -sum(stats[g]) / len(stats[g]), g))
        unseen = [p for _, _, p in sorted(ranked[best]) if p not in {r[2] for r in own}]
        want |= {(customer, i, p) for i, p in enumerate(unseen[:4], 1)}
    got = {(r.customer_id, r.place, r.product_id) for r in products.suggest_products(df, k=4).collect()}
    assert got == want


def test_required_columns_and_categories(spark, tmp_path):
    with pytest.raises(MissingColumns, match="product_id.*star_rating"):
        check_columns(spark.createDataFrame([("a",)], "review_id STRING"), ["review_id", "product_id", "star_rating"])
    (tmp_path / "c.yaml").write_text("categories:\n- Baby\n- 'Video_DVD'\n")
    listed = read_categories(spark, str(tmp_path / "c.yaml"))
    assert [r.category for r in listed.collect()] == ["Baby", "Video_DVD"]
    assert check_category(listed, "Baby") == "Baby"
    with pytest.raises(ValueError):
        check_category(listed, "Nope")
    assert default_categories(spark).count() == 37
    df = spark.createDataFrame([("Baby",), ("x",), ("x",), (None,)], "c STRING")
    assert {tuple(r) for r in unknown_categories(df, "c").collect()} == {("x", 2), (None, 1)}


def test_profile_head_union(spark):
    df = spark.createDataFrame([(2, None), (1, "a")], "n INT, s STRING")
    assert [tuple(r) for r in profile(df).orderBy("position").collect()] == [(0, "n", "int", 2, 2), (1, "s", "string", 1, 2)]
    assert head(df, 1, ["n"]).collect()[0].n == 1
    other = spark.createDataFrame([(True,)], "b BOOLEAN")
    assert union_parts([df, other]).columns == ["n", "s", "b"] and union_parts([df, other]).count() == 3


def test_metrics(spark):
    done = spark.createDataFrame(
        [("a", "o", "c", 5, 0, AT), ("a", "o", "c", 0, 1, AT), ("b", "o", "c", 3, 0, AT)], observe.LINEAGE_SCHEMA
    )
    failed = spark.createDataFrame([("z", 4)], "source_file STRING, failed_rows BIGINT")
    row = observe.run_summary(done, failed, AT, 1.23456).collect()[0]
    assert tuple(row)[1:] == (2, 3, 8, 4, 1.23) and row.pipeline_start_time == AT
    assert tuple(observe.run_totals(done.limit(0), failed.limit(0)).collect()[0]) == (0, 0, 0, 0)
    assert [r.total_rows for r in observe.running_rows(done).orderBy("source_file", "chunk_idx").collect()] == [5, 5, 3]


def test_records_keep_nulls(spark):
    df = spark.createDataFrame([("a", None, 'q"\t')], "x STRING, y STRING, z STRING")
    both = df.select(S.to_record(["x", "y", "z"]).alias("r"))
    assert both.collect()[0].r == '{"x":"a","y":null,"z":"q\\"\\t"}'
    assert tuple(both.select(S.from_record(F.col("r"), ["x", "y", "z"]).alias("s")).select("s.*").collect()[0]) == ("a", None, 'q"\t')


def load_model():
    return lambda texts: [("POSITIVE" if "good" in t else "NEGATIVE", len(t) / 10) for t in texts]


def test_sentiment(spark):
    df = spark.createDataFrame([(1, "I LOVE it, great!"), (2, "broken, but good... awful"), (3, "table"), (4, None)], "i INT, t STRING")
    got = {r.i: (r.label, r.score) for r in with_sentiment(df, "t").collect()}
    assert got[1] == ("POSITIVE", 1.0) and got[3] == ("NEUTRAL", 0.0) and got[4] == (None, None)
    assert got[2][0] == "NEGATIVE" and abs(got[2][1] + 1 / 3) < 1e-9
    model = {r.i: (r.label, r.score) for r in with_model(df, "t", load_model).collect()}
    assert model[2][0] == "POSITIVE" and model[1] == ("NEGATIVE", 1.7) and model[4] == (None, None)


def test_passages_cover_the_text(spark):
    words = [f"w{i}" for i in range(23)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " one  two "), (3, " ")], "i INT, t STRING")
    got = {}
    for r in retrieval.passages(df, "i", "t", size=8, step=5).collect():
        got.setdefault(r.i, {})[r.passage_no] = r.passage.split(" ")
    assert got[2] == {0: ["one", "two"]} and 3 not in got
    assert got[1] == {k: words[k * 5 : k * 5 + 8] for k in range(4)}


def test_nearest_like_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(60, 5))
    vectors[7] = 0
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "i INT, v ARRAY<FLOAT>")
    queries = {q: [float(x) for x in rng.normal(size=5)] for q in range(300)}
    got = {(r.query, r.rank): r.i for r in retrieval.nearest(df, "i", "v", queries, k=3).collect()}
    for q, vector in queries.items():
        v = vectors.astype("float32").astype("float64")
        norms = np.linalg.norm(v, axis=1) * np.linalg.norm(vector)
        sims = np.where(norms > 0, v @ np.array(vector) / np.where(norms > 0, norms, 1), -2).round(6)
        order = sorted(range(60), key=lambda i: (-sims[i], i))[:3]
        assert [got[q, k] for k in (1, 2, 3)] == order


def test_jdbc_options():
    target = JdbcTarget.postgres("db", "shop", user="u", password="secret")
    assert target.options()["url"] == "jdbc:postgresql://db:5432/shop" and "secret" not in repr(target)
    assert JdbcTarget.sql_server("db", "shop").options()["url"] == "jdbc:sqlserver://db:1433;databaseName=shop"
