"""Learned sentiment, the passage index and baskets, each against a plain version."""

import math
import os
import random
import re
from collections import Counter, defaultdict

import pytest

from tidemark.functions import learned
from tidemark.functions.sentiment import with_sentiment
from tidemark.plans.baskets import bought_together, pair_counts
from tidemark.plans.passage_index import build_index, candidates, nearest_passages, _asked
from tidemark.session import shared_folder

GOOD, BAD, PLAIN = ["lovely", "great", "sturdy"], ["awful", "cracked", "great for nothing"], ["it", "is", "a", "thing", "the", "box"]


def ratings(n, seed=1):
    pick, rows = random.Random(seed), []
    for i in range(n):
        good = pick.random() < 0.6
        words = [pick.choice(PLAIN) for _ in range(8)] + [pick.choice(GOOD if good else BAD) for _ in range(pick.randrange(3))]
        pick.shuffle(words)
        rows.append((i, " ".join(words), 5.0 if good else 1.0))
    return rows


def plain_terms(text):
    words = re.findall(r"[\w']+", (text or "").lower())
    return set(words) | {f"{a} {b}" for a, b in zip(words, words[1:])}


def plain_model(rows):
    sides = [(1 if r >= 4 else 0, t) for _, t, r in rows if t is not None and r is not None and (r >= 4 or r <= 2)]
    counts = [Counter(t for s, x in sides if s == side for t in plain_terms(x)) for side in (0, 1)]
    kept = [t for t in counts[0] | counts[1] if counts[0][t] + counts[1][t] >= 2]
    total = [sum(c[t] for t in kept) + len(kept) for c in counts]
    weights = {t: round(1e6 * math.log(((counts[1][t] + 1) / total[1]) / ((counts[0][t] + 1) / total[0]))) for t in kept}
    n = Counter(s for s, _ in sides)
    return weights, round(1e6 * math.log((n[1] + 1) / (n[0] + 1)))


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


def test_learned_sentiment(spark):
    rows = ratings(400) + [(1000, None, 5.0), (1001, "", 5.0), (1002, "lovely", None), (1003, "so so", 3.0), (1004, "--", 1.0)]
    frame = spark.createDataFrame(rows, "id long, body string, stars double")
    model = learned.fit(frame.where("id % 4 != 0"), "id", "body", "stars")
    weights, prior = plain_model([r for r in rows if r[0] % 4])
    assert {r.term: r.weight for r in model.weights.collect()} == weights and model.prior == prior
    got = {r.id: r.score for r in learned.scores(frame, "id", "body", model).collect()}
    assert got == {i: prior + sum(weights.get(x, 0) for x in plain_terms(t)) for i, t, _ in rows if t is not None}
    held = [(i, t, r) for i, t, r in rows if i % 4 == 0 and i < 1000]
    listed = {r.id: r.score for r in with_sentiment(frame, "body").collect()}
    assert auc([(got[i], r > 3) for i, _, r in held]) > auc([(listed[i], r > 3) for i, _, r in held]) + 0.1
    calibrated = learned.calibrate(frame.where("id % 4 = 0"), "id", "body", "stars", model)
    assert sum(r.n for r in calibrated.shares.collect()) == len(held) + 1
    sure = {r.id: r.probability for r in learned.with_probability(learned.scores(frame, "id", "body", model), calibrated).collect()}
    assert all(0 < p < 1 for p in sure.values()) and sure[max(got, key=got.get)] > 0.6 > 0.4 > sure[min(got, key=got.get)]


def test_model_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, body string, stars double")
    model = learned.fit(empty, "id", "body", "stars")
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "id long, body string")
    assert [tuple(r) for r in learned.scores(frame, "id", "body", model).collect()] == [(1, 0)]


def ranking(docs, queries, size, step, k):
    passages = {}
    for i, text in docs:
        tokens = (text or "").split()
        for n in range(1 + max(0, math.ceil((len(tokens) - size) / step))) if tokens else ():
            words = re.findall(r"[^\W_]+", " ".join(tokens[n * step : n * step + size]).lower())
            if words:
                passages[i, n] = Counter(words)
    total, df = sum(sum(c.values()) for c in passages.values()), Counter(t for c in passages.values() for t in c)
    out = {}
    for q, text in queries:
        asked, scored = Counter(re.findall(r"[^\W_]+", (text or "").lower())), []
        for (i, n), c in passages.items():
            m = 250 + 750 * sum(c.values()) * len(passages) // total
            score = sum(
                times * math.floor(1000 * math.log(1 + (len(passages) - df[t] + 0.5) / (df[t] + 0.5))) * ((2_200_000 * c[t]) // (1000 * c[t] + 12 * m // 10))
                for t, times in asked.items() if c[t]
            )
            if score:
                scored.append((-score, i, n))
        for place, (s, i, n) in enumerate(sorted(scored)[:k]):
            out[q, place + 1] = (i, n, -s)
    return out


@pytest.mark.parametrize("block", [2, 1024])
def test_passage_index(spark, block):
    pick = random.Random(4)
    words = [f"w{int(pick.expovariate(0.05))}" for _ in range(400)] + ["the"] * 300
    docs = [(i, " ".join(pick.choice(words) for _ in range(pick.randrange(60)))) for i in range(200)] + [(900, None), (901, "- -"), (902, "the " * 50)]
    queries = [(i, " ".join(pick.choice(words) for _ in range(6))) for i in range(12)] + [(50, "the the"), (51, "unheard"), (52, None), (53, "w0 w399 the")]
    left = spark.createDataFrame(docs, "id long, body string")
    right = spark.createDataFrame(queries, "q long, ask string")
    index = build_index(left, "id", "body", size=10, step=7, block=block)
    got = {(r.q, r["rank"]): (r.id, r.passage_no, r.score) for r in nearest_passages(index, right, "q", "ask", k=3).collect()}
    assert got == ranking(docs, queries, 10, 7, 3) and len(got) > 30
    # Blocks that cannot matter lead to no passage.
    asked = _asked(index, right, "q", "ask")
    looked_at = candidates(index, asked, "q", 3).count()
    every = asked.join(index.postings, "term").select("q", "id", "passage_no").distinct().count()
    assert looked_at < every * (0.5 if block == 2 else 1)
    plan = nearest_passages(index, right, "q", "ask")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def pairs_of(lines, support):
    baskets = defaultdict(set)
    for b, i in lines:
        if b is not None and i is not None:
            baskets[b].add(i)
    counts = Counter()
    for items in baskets.values():
        counts.update((a, b) for a in items for b in items if a < b)
    return {p: n for p, n in counts.items() if n >= support}


@pytest.mark.parametrize("block", [1, 3, 512])
def test_bought_together(spark, block):
    pick = random.Random(8)
    lines = [(f"b{pick.randrange(30)}", f"i{int(pick.expovariate(0.1))}") for _ in range(600)] + [(None, "i1"), ("b1", None), ("b1", "i1"), ("b1", "i1")]
    frame = spark.createDataFrame(lines, "basket string, item string")
    want = pairs_of(lines, 3)
    assert {(r.a, r.b): r.together for r in pair_counts(frame, "basket", "item", support=3, block=block).collect()} == want
    best = defaultdict(list)
    for (a, b), n in want.items():
        best[a].append((-n, b))
        best[b].append((-n, a))
    got = {(r["item"], r["rank"]): (r.other, r.together) for r in bought_together(frame, "basket", "item", 2, support=3, block=block).collect()}
    assert got == {(i, n + 1): (o, -t) for i, x in best.items() for n, (t, o) in enumerate(sorted(x)[:2])}
    assert bought_together(frame.limit(0), "basket", "item").count() == 0


def test_one_very_large_basket(spark):
    """Of 100,000 items 300 are bought elsewhere too; no cap leaves one out."""
    large = spark.range(100_000).selectExpr("'large' AS basket", "id AS item")
    small = spark.range(300).selectExpr("concat('s', id % 3) AS basket", "id * 7 AS item")
    got = pair_counts(large.union(small), "basket", "item")
    assert got.count() == 3 * (100 * 99 // 2) and got.where("together != 2").isEmpty()


def test_passage_index_is_small(spark):
    """Postings are written once, in a few bytes each, and not shuffled."""
    pick = random.Random(5)
    texts = [(i, " ".join(f"w{int(pick.expovariate(0.01))}" for _ in range(100))) for i in range(4000)]
    folder = shared_folder(spark)
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)
    before = size()
    index = build_index(spark.createDataFrame(texts, "id long, body string"), "id", "body")
    assert size() - before < 4 * index.postings.count()


def test_passages_of_repeated_and_missing_keys(spark):
    """Rows of one key count as one passage, those without a key are counted but not found."""
    texts = [(1, "a b"), (2, "a c"), (1, "a b"), (None, "a b"), (3, "d e"), (4, "f"), (5, "g"), (6, "h"), (7, "i")]
    asked = spark.createDataFrame([(9, "a b")], "q long, ask string")
    once = build_index(spark.createDataFrame(texts, "id long, body string"), "id", "body")
    found = [(r.id, r.score) for r in nearest_passages(once, asked, "q", "ask").orderBy("rank").collect()]
    weight = lambda df: math.floor(1000 * math.log(1 + (9 - df + 0.5) / (df + 0.5)))
    impact = 2_200_000 // (1000 + 12 * (250 + 750 * 2 * 9 // 14) // 10)
    assert found == [(1, 2 * impact * (weight(4) + weight(3))), (2, impact * weight(4))]
