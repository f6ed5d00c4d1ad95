import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives as N
from tidemark.llm.frames import bounded

SCHEMA = "vec_id long, embedding array<float>, label int, score double, anchor string"


def usable(i, v, label, size):
    return i is not None and v and label is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)


def mined(rows, size, positives=5, negatives=10, every=10):
    one = {}
    for i, v, label in rows:
        if usable(i, v, label, size):
            v = [float(np.float32(x)) for x in v]
            one[i] = min(one.get(i, (label, v)), (label, v))
    out = []
    ints = {i: [int(np.floor(256 * x)) for x in v] for i, (_, v) in one.items()}
    for a in one:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(ints[a], ints[i])), i) for i in one if i != a)
        same = [(-s, i) for s, i in scored if one[i][0] == one[a][0]][:positives]
        for p, pos in same:
            fits = [(-s, i) for s, i in scored if one[i][0] != one[a][0] and 30 * p <= -100 * s <= 90 * p][:negatives]
            out += [(a, pos, k + 1, i, p, s) for k, (s, i) in enumerate(fits)]
    return sorted(out)


def frame(spark, rows):
    return bounded(spark).createDataFrame([(i, v, label, 0.5, "x") for i, v, label in rows], SCHEMA)


def found(spark, rows, **options):
    got = N.hard_negatives(frame(spark, rows).repartition(5), F.col("vec_id") % 10 == 0, **options)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("block", [7, 1000])
def test_against_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(N, "GATHERED", 50)
    monkeypatch.setattr(N, "CELLS", 500)
    pick = random.Random(5)
    rows = [(i, [pick.gauss(0, 0.2) + (i % 3 == d) * 0.3 for d in range(6)], i % 3) for i in range(300)]
    want = mined(rows, 6)
    assert found(spark, rows, anchor_block=block) == want and len(want) > 300


def test_ties_and_odd_rows(spark):
    pick = random.Random(6)
    # Few values, so that scores are often equal, zero ones among them.
    rows = [(i, [float(pick.choice((0, 0, 0.25, 0.5))) for _ in range(3)], pick.choice((0, 1, 1))) for i in range(-40, 80)]
    rows += [
        (200, None, 1), (210, [0.1, None, 0.2], 1), (220, [0.1, float("nan"), 0.2], 1), (230, [0.1, float("inf"), 0.2], 1),
        (240, [0.1, 0.2], 1), (250, [], 1), (260, [0.5, 0.5, 0.5], None), (None, [0.5, 0.5, 0.5], 1), (270, [-0.5, -0.5, 0.0], 1),
        (280, [0.5, 0.5, 0.5], 2), (290, [0.5, 0.25, 0.5], 0), (290, [0.5, 0.25, 0.5], 0), (300, [0.5, 0.0, 0.5], 1), (300, [0.5, 0.5, 0.0], 1),
    ]
    assert found(spark, rows) == mined(rows, 3)
    assert found(spark, []) == [] and found(spark, [(0, [0.5], 1)]) == [] and found(spark, [(0, None, 1)]) == []


def test_large_numbers_are_exact():
    pick = np.random.default_rng(4)
    for most in (200, 1 << 20, 1 << 27):
        x, y = (pick.integers(-most, most, (20, 8)).astype(float) for _ in range(2))
        want = [[sum(int(a) * int(b) for a, b in zip(p, q)) for q in y] for p in x]
        assert N.inner_products(x, y).tolist() == want


def test_order_of_packed_keys():
    pick = random.Random(7)
    big = 1 << 62
    rows = [tuple(pick.choice((-big, -1, 0, 1, 5, big)) for _ in range(2)) + (pick.choice((0, 1)), pick.choice((-big, -3, 0, 9, big))) for _ in range(400)]
    a, s, k, i = (np.array(x) for x in zip(*rows))
    keys = N.packed_keys(a, s, k.astype(np.uint8), i)
    assert list(zip(*(x.tolist() for x in N.unpacked_keys(keys)))) == rows
    order = sorted(range(len(rows)), key=lambda n: keys[n].as_py())
    assert [rows[n] for n in order] == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))


def test_windows_of_a_stream_end():
    keys = [(1, 100, 0, 5), (1, 95, 1, 6), (1, 90, 1, 7), (1, 30, 1, 8), (1, 29, 1, 9), (2, 10, 1, 1), (2, 9, 0, 2), (2, 3, 1, 4)]
    assert list(N.windows_of_stream(iter(keys), 30, 90, 10)) == [(1, 5, 1, 7, 100, 90), (1, 5, 2, 8, 100, 30), (2, 2, 1, 4, 9, 3)]
    assert Counter(r[0] for r in N.windows_of_stream(iter(keys), 30, 90, 1)) == {1: 1, 2: 1}
