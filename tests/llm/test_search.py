import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import multiindex
from tidemark.llm.editmatch import begins_nearly, benchmark_matches, best_distance, item_masks, without_benchmark
from tidemark.llm.frames import bounded
from tidemark.llm.multiindex import Shard, nearest_neighbours
from tidemark.llm.queries import op2_benchmark_edits, op4_multi_index_search, op8_separator_scan
from tidemark.llm.separators import END, byte_encoding, scan_separators, token_counts


def exact_neighbours(rows, k=10):
    """rows: (id, vector). For every id divisible by 100: the nearest."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = np.array([i for i, _ in good])
    matrix = np.array([v for _, v in good], float)
    out = {}
    for i, v in good:
        if i % 100 == 0:
            d = np.sqrt(np.square(matrix - np.array(v)).sum(axis=1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(d[j])) for j in order]
    return out


@pytest.mark.parametrize("table", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, table):
    rows = [tuple(r) for r in spark.read.parquet(f"{table}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = exact_neighbours(rows)
    got = defaultdict(list)
    for r in op4_multi_index_search(spark, table).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (x[1], x[0]))
        exact = dict(want[q])
        assert all(abs(exact[i] - s) < 1e-12 for i, s in found if i in exact)


def test_radius_is_complete():
    pick = np.random.default_rng(2)
    codes = pick.integers(0, 256, (500, 6)).astype(np.uint8)
    shard = Shard(np.arange(500), np.zeros((500, 2)), codes)
    for radius in (0, 3, 7, 12, 20, 48):
        far = np.bitwise_count(codes ^ codes[7]).sum(axis=1)
        assert shard.within(codes[7], radius).tolist() == np.flatnonzero(far <= radius).tolist()


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(multiindex, "SHARD", 5)
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(90, 120)] + [
        (100, [2.0, 1.0, 1.0]), (200, None), (300, [0.0, 0.0, 0.0]), (400, [1.0, None, 2.0]), (500, [1.0, float("nan"), 2.0]),
        (600, [1.0, float("inf"), 2.0]), (700, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (800, []), (900, [3.0, 1.0, 2.0]), (900, [3.0, 1.0, 2.0]),
    ]
    df = bounded(spark).createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = defaultdict(list)
    found = nearest_neighbours(df, F.col("vec_id") % 100 == 0, query_block=2).orderBy("query_id", "rank")
    for r in found.collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = exact_neighbours([r for r in rows if r[1] is None or len(r[1]) == 3])
    assert {q: [round(s, 9) for _, s in v] for q, v in got.items() if q != 100} == {
        q: [round(s, 9) for _, s in v] for q, v in want.items() if q != 100
    }
    assert got[900] == want[900]
    assert nearest_neighbours(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert nearest_neighbours(df.where("vec_id = 100").limit(1), F.lit(True)).count() == 0


def distance_by_table(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def plain(text):
    import re

    return re.sub(r"[\W_]+", " ", (text or "").lower()).strip()


def exact_matches(docs, items, budget=0.1, least=32):
    out = []
    for d, text in docs:
        for i, item in items:
            a, b = plain(item), plain(text)
            if 8 <= len(a) < least and f" {a} " in f" {b} ":
                out.append((d, i, 0, len(a)))
            if len(a) >= least and b and (n := distance_by_table(a, b)) <= int(budget * len(a)):
                out.append((d, i, n, len(a)))
    return Counter(out)


def test_bit_parallel_distance():
    pick = random.Random(1)
    for _ in range(300):
        item = "".join(pick.choices("abc", k=pick.randrange(1, 40)))
        text = "".join(pick.choices("abc", k=pick.randrange(0, 60)))
        assert best_distance(item_masks(item), len(item), text) == distance_by_table(item, text)


def test_begins_nearly():
    pick = random.Random(8)
    for _ in range(3000):
        piece = "".join(pick.choices("ab", k=pick.randrange(1, 6)))
        text = "".join(pick.choices("ab", k=pick.randrange(0, 9)))
        edits = min(distance_whole(piece, text[:n]) for n in range(len(text) + 1))
        assert begins_nearly("xx" + text, 2, piece) == (edits <= 1)


def distance_whole(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_edit_matches_of_odd_rows(spark, monkeypatch):
    pick = random.Random(5)
    word = lambda: "".join(pick.choices("abcdefgh", k=pick.randrange(2, 8)))
    items = [(n, " ".join(word() for _ in range(14))) for n in range(6)] + [(6, "Too short?"), (10, "tiny"), (11, "第一章的题目是什么"), (7, None), (8, ""), (None, "a null id has this item text, long enough")]
    items.append((9, items[0][1].upper() + "!"))
    docs = []
    for n in range(40):
        text = list(" ".join(word() for _ in range(30)) + " " + items[n % 6][1] + " " + " ".join(word() for _ in range(9)))
        for _ in range(n % 14):
            at = pick.randrange(len(text))
            text[at : at + pick.randrange(2)] = pick.choice(["", "x", "yz"])
        docs.append((n, "".join(text)))
    docs += [(100, None), (101, ""), (None, items[3][1]), (102, items[2][1]), (102, items[2][1]), (103, items[11][1] + " tail"), (104, items[1][1][:40])]
    docs += [(105, "it is too short."), (106, "tattoo short"), (107, "too shorts, too  SHORT"), (108, "问：第一章的题目是什么？ tiny"), (109, "too short")]
    df = bounded(spark).createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    want = exact_matches(docs, items)
    assert len(want) > 30
    for block in (2_000_000, 100):
        assert Counter(tuple(r) for r in benchmark_matches(df, bench, block_chars=block).collect()) == want
    left = without_benchmark(df, bench)
    assert left.columns == df.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(d for d, _ in docs if not any(k[0] == d for k in want))
    assert benchmark_matches(df.limit(0), bench).count() == benchmark_matches(df, bench.limit(0)).count() == 0


def test_edit_matches_of_the_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()][:60]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = Counter(tuple(r) for r in op2_benchmark_edits(spark, sf).collect())
    keep = {d for d, t in docs if len(t) < 1500}
    want = exact_matches([d for d in docs if d[0] in keep], items)
    assert Counter({k: v for k, v in got.items() if k[0] in keep}) == want


def test_flat_files(spark, tmp_path):
    pick = np.random.default_rng(3)
    sizes = [0, 5, 0, 0, 7, 1, 12, 3]
    ids = np.concatenate([np.append(pick.integers(0, 900, n), END) for n in sizes] + [pick.integers(0, 900, 4)]).astype("<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    (tmp_path / "c.bin").write_bytes(np.full(3, END, "<u2").tobytes())
    (tmp_path / "d.bin").write_bytes(np.arange(9, dtype="<u2").tobytes())
    for block in (2, 4, 10, 1 << 20):
        got = bounded(spark) and scan_separators(spark, str(tmp_path), block_bytes=block).orderBy("file", "ordinal").collect()
        assert [r.n_tokens for r in got if r.file == "a.bin"] == [*sizes, 4]
        assert [r.ordinal for r in got if r.file == "a.bin"] == list(range(9))
        assert [(r.start, r.n_tokens, r.ended) for r in got if r.file == "c.bin"] == [(0, 0, True), (1, 0, True), (2, 0, True)]
        assert [(r.start, r.n_tokens, r.ended) for r in got if r.file == "d.bin"] == [(0, 9, False)]
        assert not [r for r in got if r.file == "b.bin"]


def test_token_counts(spark, sf):
    rows = [(1, None), (2, ""), (None, "no id"), (None, None), (3, "<|endoftext|> é 日本 " * 50), (3, "same id"), (4, "x" * 90000)]
    df = bounded(spark).createDataFrame([(*r, "f") for r in rows], "doc_id long, text string, file string").repartition(3)
    count = lambda t: len(byte_encoding().encode_ordinary(t or ""))
    got = Counter((r.doc_id, r.n_tokens) for r in token_counts(df).collect())
    assert got == Counter((i, count(t)) for i, t in rows)
    assert token_counts(df.limit(0)).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(tuple(r) for r in op8_separator_scan(spark, sf).collect()) == Counter((r.doc_id, count(r.text)) for r in docs)
