from collections import Counter

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_packing import check
from tests.llm.test_search import plain
from tidemark.llm.frames import bounded
from tidemark.session import stored


def lines_kept(docs):
    """docs: (id, text) with distinct known ids. What the line stage leaves: lines under 40 bytes stay where they are."""
    first = {(i, p): (a, b) for i, p, a, b in brute.all_line_classes(docs)}
    out = []
    for i, text in docs:
        split = (text or "").split("\n")
        kept = [x for p, x in enumerate(split) if len(x.strip().encode()) < 40 or first[i, p] == (i, p)]
        if len(kept) == len(split):
            out.append((i, text))
        elif "\n".join(kept).strip():
            out.append((i, "\n".join(kept)))
    return out


def test_stages_of_the_table(spark, sf):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "lines", "near_duplicates", "decontaminate", "pack"]
    start = spark.read.parquet(f"{sf}/documents.parquet")
    docs, pairs = start, [tuple(r) for r in start.select("doc_id", "text").collect()]
    for name in ("language", "lines", "near_duplicates", "decontaminate"):
        docs = stored(stages[name](spark, docs, sf), name)
        assert docs.columns == start.columns and docs.dtypes == start.dtypes
        got = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        if name == "language":
            assert len(got) > 0.97 * len(pairs) and set(got) <= set(pairs)
            want = got
        elif name == "lines":
            want = lines_kept(pairs)
        elif name == "near_duplicates":
            keep = {c for _, c in brute.near_duplicates(pairs)}
            want = [p for p in pairs if p[0] in keep]
        else:
            items = [plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            want = [p for p in pairs if not any(i in plain(p[1]) for i in items)]
            assert len(want) <= len(pairs)
        assert Counter(got) == Counter(want), name
        pairs = got
    rows = [r.asDict() for r in stages["pack"](spark, docs, sf).selectExpr("*", "crc32(ids) ids_crc32").collect()]
    assert check(rows, pairs) <= 2048
    whole = corpus_pipeline.run(spark, sf)
    assert Counter((r.doc_id, r.start, r.length) for r in whole.collect()) == Counter((r["doc_id"], r["start"], r["length"]) for r in rows)


def test_odd_rows(spark, sf):
    line = "A line that is long enough to be compared with other lines, number %d of them."
    prose = " ".join(r.text for r in spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en'").limit(3).collect())
    rows = [(1, None, "en"), (2, "", None), (None, prose[:900], "en"), (None, None, None), (3, "123 456", "en"), (4, prose[:2000], "en"),
            (4, prose[:2000], "en"), (5, prose[:2000] + "\n" + line % 1, None), (6, line % 1, "en"), (7, prose * 30, "de")]
    docs = bounded(spark).createDataFrame(
        [(*r, "s", 7, 1, 2.0, "x") for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, k1 int, score double, _row string",
    ).repartition(3)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), sf)
        assert empty.count() == 0
        docs_next = stored(stage(spark, docs, sf), name)
        if name != "pack":
            assert docs_next.columns == docs.columns
        docs = docs_next
    assert docs.count() > 0
