import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lexical as L
from tidemark.llm.frames import bounded

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(L.TERM, (text or "").translate(LOWER))


def ranked(docs, items, k=20):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, text in dict.fromkeys(items):
        wanted.setdefault(i, Counter()).update(terms(text))
    out = []
    for item, asked in wanted.items():
        scores = []
        for i, c in counts:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // length
            s = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, times in asked.items() if t in c
            )
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, n + 1, i, -s) for n, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return Counter(out)


def found(spark, docs, items, **options):
    spark = bounded(spark)
    left = spark.createDataFrame([(i, t, 3, "x") for i, t in docs], "doc_id long, text string, score int, item_id string").repartition(3)
    right = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")
    got = L.ranked_documents(left, right, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(tuple(r) for r in got.collect())


@pytest.mark.parametrize("block", [60, 1 << 20])
def test_against_plain_version(spark, block, monkeypatch):
    monkeypatch.setattr(L, "RUN_BYTES", 64)
    monkeypatch.setattr(L, "GATHERED", 10)
    pick = random.Random(2)
    words = ["a", "B", "ab", "abc", "é", "éa", "x1", "Ünder", "漢字", "字", "zz"]
    seps = [" ", ". ", "-", "\n", "_", "\x00", "''", "\x7f"]
    text = lambda n: "".join(pick.choice(words) + pick.choice(seps) for _ in range(n))
    docs = [(i, text(pick.randrange(1, 90))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, " .-"), (None, "ab abc"), (None, "ab abc"), (7, "ab zz"), (503, "zz " * 70_000), (504, "q" * 5000 + " ab"), (505, "A")]
    items = [(i, text(12)) for i in range(9)] + [(20, None), (21, ""), (None, "ab x1 zz"), (22, "nowhere"), (23, "ab ab AB"), (23, "ab ab AB"), (24, "zz"), (24, "é")]
    assert found(spark, docs, items, k=6, block_bytes=block) == ranked(docs, items, k=6)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == found(spark, [(1, "a")], []) == found(spark, [(1, "..")], [(1, "a")]) == Counter()
    # A term of every document still counts a little, one that half of them lack counts more.
    docs = [(i, "a b" if i % 2 else "a") for i in range(40)]
    assert found(spark, docs, [(1, "a"), (2, "a b")]) == ranked(docs, [(1, "a"), (2, "a b")])


def test_windows_cut_beside_guards():
    data = np.frombuffer(b"ab cd  " + b"x" * 50 + b" e", np.uint8)
    for size in (1, 3, 7, 100):
        cut = list(L.windows(data, size))
        assert [a for a, _ in cut[1:]] == [b for _, b in cut[:-1]] and cut[0][0] == 0 and cut[-1][1] == len(data)
        assert all(data[b - 1] == L.GUARD for _, b in cut[:-1])


def test_wide_counts():
    for x in ([], [1, 2], [1, 70_000]):
        assert L._wide(L._narrow(np.array(x, np.int64))).tolist() == x
