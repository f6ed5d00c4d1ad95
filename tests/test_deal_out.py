from pyspark.sql import functions as F

from tidemark import session


def test_shuffles_are_dealt_out_by_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", 100)
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    try:
        session.deal_out(spark, 100 * (base + 30))
        assert spark.conf.get(session.INITIAL_PARTITIONS) == str(base + 30)
        assert {(r.k, r["count"]) for r in rows.collect()} == {(k, 143 if k < 6 else 142) for k in range(7)}
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert f", {base + 30})" in plan
        # Less than the session has: its own number is used.
        session.deal_out(spark, 100)
        assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None
    finally:
        session.deal_out(spark, 0)
