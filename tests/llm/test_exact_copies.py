import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import fingerprints as P
from tidemark.llm.frames import bounded

SCHEMA = "doc_id long, text string, n_bytes long, kept boolean"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    return (text or "").translate(LOWER)


def classes(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(plain(t), []).append(i)
    out = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known, default=None)
        for n, i in enumerate(sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)):
            out[i, keep, len(ids), n == 0, len(t.encode()), hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


def frame(spark, docs):
    return bounded(spark).createDataFrame([(i, t, 7, None) for i, t in docs], SCHEMA)


def got(found):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.n_bytes, r.sha256) for r in found.collect())


def test_fingerprints_compose():
    pick = np.random.default_rng(1)
    for base in P.BASES:
        x = pick.integers(0, 256, 5000).astype(np.uint8)
        value = sum((int(b) + 1) * pow(base, i, P.MODULUS) for i, b in enumerate(x)) % P.MODULUS
        for cuts in ([0, 5000], [0, 0, 7, 7, 4096, 5000, 5000], [0, *range(1, 5000, 13), 5000]):
            made = P.chunk_hashes(x, np.array(cuts), base)
            parts = P.shifted(made, np.array(cuts[:-1]), base)
            assert sum(map(int, parts)) % P.MODULUS == value
    a, b = (pick.integers(0, P.MODULUS, 1000).astype(np.uint64) for _ in range(2))
    assert P.times(a, b).tolist() == [int(x) * int(y) % P.MODULUS for x, y in zip(a, b)]


@pytest.mark.parametrize("chunk", [16, 1 << 20])
def test_odd_texts(spark, chunk):
    pick = random.Random(3)
    long = "".join(pick.choice("abcXYZ é\n") for _ in range(3000))
    docs = [
        (1, None), (2, ""), (3, "ABC"), (4, "abc"), (4, "Abc"), (None, "aBC"), (None, "only"), (None, "ONLY"), (5, long),
        (6, long.lower()), (7, long.upper()), (8, long[:-1] + "!"), (9, long[:-1] + "?"), (9, long[:-1] + "?"), ((1 << 63) - 1, "abc"),
        (10, "ÄÖ"), (11, "äö"), (12, "x" * 16), (13, "X" * 32), (14, "x" * 33), (15, "\x00"), (16, "\x00\x00"),
    ]
    assert got(P.exact_classes(frame(spark, docs), chunk_bytes=chunk)) == classes(docs)
    kept = P.without_copies(frame(spark, docs), chunk_bytes=chunk)
    assert kept.columns == ["doc_id", "text", "n_bytes", "kept"]
    assert Counter(plain(r.text) for r in kept.collect()) == Counter({plain(t) for _, t in docs})
    assert P.exact_classes(frame(spark, []), chunk_bytes=chunk).count() == 0


@pytest.mark.parametrize("chunk", [4, 1 << 20])
def test_equal_fingerprints_of_different_texts(spark, chunk):
    """At the point 1 the polynomial is a sum of bytes, so all orders of the same letters collide."""
    docs = [(i, "".join(t)) for i, t in enumerate(["listen", "silent", "LISTEN", "enlist", "silent", "abcdefgh", "hgfedcba", "abcdefgh", "other"])]
    assert got(P.exact_classes(frame(spark, docs), chunk_bytes=chunk, bases=(1, 1))) == classes(docs)


def test_group_of_many_copies(spark):
    docs = [(i, "the same text " * 50) for i in range(3000)] + [(i, f"own {i}") for i in range(3000, 3100)]
    assert got(P.exact_classes(frame(spark, docs).repartition(7))) == classes(docs)
