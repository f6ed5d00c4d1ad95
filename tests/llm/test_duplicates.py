import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F
from tests.llm import brute
from tidemark.llm.components import components
from tidemark.llm.frames import bounded
from tidemark.llm import hashing, lines, probminhash
from tidemark.llm.lines import (
    SKETCH, SKETCH_LEAST, SKETCH_REGISTERS, _shingles, drop_repeated_lines, line_classes, pair_jaccards, set_registers, sketches, unlike,
)
from tidemark.llm.probminhash import near_duplicates, one_of_each_class, probability_jaccard, registers
from tidemark.llm.queries import op3_near_duplicates, op7_fuzzy_lines

WORDS = [f"w{i}" for i in range(400)]


def text(seed, n=120):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def edited(base, seed, changes):
    words, pick = base.split(" "), random.Random(seed)
    for _ in range(changes):
        words[pick.randrange(len(words))] = pick.choice(WORDS)
    return " ".join(words)


BASE = text(1)
ROWS = [
    (4, BASE), (3, BASE), (8, edited(BASE, 5, 1)), (9, edited(BASE, 6, 2)), (None, edited(BASE, 7, 1)), (10, text(2)),
    (11, text(3)), (12, text(3).upper()), (13, None), (14, ""), (None, None), (15, " \n "), (16, "one two"), (17, "one two"),
    (18, "one two three"), (19, "x y z a b"), (20, text(9) + " again" * 40), (21, text(10) + " again" * 40), (20, text(30)),
    (22, text(30)), (22, text(30)), (None, text(40)), (None, text(40)),
]


def frame(spark, rows, extra="id long"):
    return bounded(spark).createDataFrame([(*r, 7) for r in rows], f"doc_id long, text string, {extra}").repartition(3)


def test_registers_estimate_probability_jaccard():
    x = {i: 1.0 + (i % 3) for i in range(300)}
    y = {i: 1.0 + (i % 2) for i in range(60, 320)}
    hashes = lambda d: np.array([(k + 1) * 0x9E3779B97F4A7C15 % (1 << 64) for k in d], np.uint64)
    both = np.concatenate([hashes(x), hashes(y)])
    owner = np.repeat([0, 1], [len(x), len(y)])
    won = registers(both, owner, np.array([*x.values(), *y.values()]), 2, 4096)
    exact = brute.probability_jaccard(x, y)
    assert abs((won[0] == won[1]).mean() - exact) < 0.03
    ox, oy = np.argsort(hashes(x)), np.argsort(hashes(y))
    fast = probability_jaccard(hashes(x)[ox], np.array([*x.values()])[ox], hashes(y)[oy], np.array([*y.values()])[oy])
    assert fast == pytest.approx(exact, rel=1e-9)


def test_set_registers_estimate_jaccard():
    x, y = hashing.mix(np.arange(30, dtype=np.uint64)), hashing.mix(np.arange(6, 36, dtype=np.uint64))
    won = set_registers(np.concatenate([x, y]), np.repeat([0, 1], 30), 2, 8192)
    assert abs((won[0] == won[1]).mean() - 24 / 36) < 0.03


def test_components(spark):
    pick = random.Random(3)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)]
    df = spark.createDataFrame([*edges, (5, 5), (None, 4)], "a long, b long").repartition(5)
    got = {r.node: r.root for r in components(df).collect()}
    want = brute.components(1300, edges)
    assert got == {n: want[n] for n in range(1300) if want[n] != n}
    assert components(df.limit(0)).count() == 0


@pytest.mark.parametrize("extra", ["id long", "root long", "k1 long"])
def test_near_duplicates_of_odd_rows(spark, extra):
    docs = frame(spark, ROWS, extra)
    got = Counter(tuple(r) for r in near_duplicates(docs).collect())
    assert got == Counter(brute.near_duplicates(ROWS))
    left = one_of_each_class(docs)
    assert left.columns == docs.columns
    ids = Counter(r.doc_id for r in left.collect())
    assert ids == Counter([3, 10, 11, 13, 14, None, 15, 16, 18, 19, 20, 21, 20, None])


def test_near_duplicates_of_the_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in op3_near_duplicates(spark, sf).collect()) == Counter(brute.near_duplicates(docs))


def test_empty_tables(spark):
    docs = frame(spark, []).limit(0)
    assert near_duplicates(docs).count() == one_of_each_class(docs).count() == 0
    assert line_classes(docs).count() == drop_repeated_lines(docs).count() == 0


LONG = "This line is long enough to be compared with all the other lines of the corpus, %s."


def test_lines_of_odd_rows(spark):
    rows = [
        (3, "short\n" + LONG % "once" + "\n" + LONG % "twice"), (2, LONG % "ONCE" + "\nshort"), (5, "  " + LONG % "once" + " \n\nshort"),
        (6, LONG % "once"), (7, None), (8, ""), (9, "\n\n"), (None, LONG % "once" + "\ntail"), (10, (LONG % "ten\n") * 3),
        (11, "unlike all of the others, 0123456789 0123456789 0123456789"),
    ]
    got = Counter(tuple(r) for r in drop_repeated_lines(frame(spark, rows, "body long")).select("doc_id", "text").collect())
    want = [
        (3, "short"), (2, LONG % "ONCE" + "\nshort"), (5, "\nshort"), (7, None), (8, ""), (9, "\n\n"), (None, "tail"), rows[-1],
    ]
    assert {k: v for k, v in got.items() if k[0] != 10} == Counter(want)


def test_short_lines_have_classes(spark):
    rows = [(3, "Yes\n\n \t\na"), (2, " yes \nSee also:\n\u7b2c\u4e00\u7ae0"), (5, "a\nSEE ALSO:\nno"), (6, "\u7b2c\u4e00\u7ae0\n" + LONG % "long")]
    got = sorted((r.doc, r.place, r.first_doc, r.first_place) for r in line_classes(frame(spark, rows)).collect())
    assert got == [
        (2, 0, 2, 0), (2, 1, 2, 1), (2, 2, 2, 2), (3, 0, 2, 0), (3, 3, 3, 3), (5, 0, 3, 3), (5, 1, 2, 1), (5, 2, 5, 2), (6, 0, 2, 2), (6, 1, 6, 1),
    ]
    assert {r.doc_id: r.text for r in drop_repeated_lines(frame(spark, rows)).collect()} == dict(rows)
    assert {r.doc_id: r.text for r in drop_repeated_lines(frame(spark, rows), stay_bytes=0).collect()} == {
        2: rows[1][1], 3: "\n \t\na", 5: "no", 6: LONG % "long",
    }


def test_all_lines_of_the_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in op7_fuzzy_lines(spark, sf).collect()) == Counter(brute.all_line_classes(docs))


def test_sketches_let_similar_lines_through(spark):
    """Pairs at the threshold and just above it, from short to long; exact similarity as for strings of letters."""
    pick = random.Random(9)
    x, y = [], []
    for n in range(40, 400, 3):
        line = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
        at = pick.randrange(4, n - 4)
        x.append(line)
        y.append(line[:at] + "#" * max(1, n // 12 - 3) + line[at + max(1, n // 12 - 3) :])
    jaccard = [len(a & b) / len(a | b) for a, b in (({s[k : k + 4] for k in range(len(s) - 3)} for s in p) for p in zip(x, y))]
    left, right = pa.array(x), pa.array(y)
    assert np.allclose(pair_jaccards(left, right, 4), jaccard)
    sketch = []
    for side in (left, right):
        made, line = _shingles(side, 4)
        made = sketches(set_registers(made, line, len(side), 161))
        sketch.append(np.stack([made[s] for s in SKETCH], axis=1).view(np.uint64))
    apart = unlike(*sketch)
    assert all(d <= SKETCH_REGISTERS - SKETCH_LEAST for d, j in zip(apart, jaccard) if j >= 0.8) and sum(j >= 0.8 for j in jaccard) > 50
    strangers = unlike(sketch[0], np.roll(sketch[1], 7, axis=0))
    assert (strangers > SKETCH_REGISTERS - SKETCH_LEAST).all()


def test_lines_with_one_changed_letter(spark):
    pick = random.Random(5)
    letters = {"latin": "abcdefghijklmnopqrstuvwxyz0123456789", "greek": "".join(map(chr, range(0x3B1, 0x3CA))), "han": "".join(map(chr, range(0x4E00, 0x4F00)))}
    rows = []
    for alphabet in letters.values():
        for n in range(40, 81):
            # No string of four letters twice, so that the similarity is (n - 7) / (n + 1).
            while len({(line := "".join(pick.choices(alphabet, k=n)))[k : k + 4] for k in range(n - 3)}) < n - 3:
                pass
            at = n // 2
            other = line[:at] + next(c for c in alphabet if c != line[at]) + line[at + 1 :]
            rows += [(len(rows), line), (len(rows) + 1, other)]
    got = {r.doc: r.first_doc for r in line_classes(frame(spark, rows)).collect()}
    want = {i: j for i, _, j, _ in brute.all_line_classes(rows)}
    assert want == {i: i - i % 2 for i in range(len(rows))}
    assert sum(got[i] != want[i] for i in want) <= 0.02 * len(want)


def test_only_lines_with_a_partner_meet_by_their_texts(spark, monkeypatch):
    met = []

    def across(dealt, judge):
        met.append({r.id for r in dealt.collect()})
        return probminhash.links_across(dealt, judge)

    monkeypatch.setattr(lines, "links_across", across)
    # All share one bucket.
    bucket = F.lit(1).cast("long").alias("bucket")
    monkeypatch.setattr(lines, "_buckets", lambda rows, *_: lines._occurrences(rows).select(bucket, F.col("h1").alias("id")))
    base = [text(100 + i, 30) for i in range(4)]
    like = edited(base[0], 3, 1)

    docs = frame(spark, [(i, t) for i, t in enumerate([*base, like])])
    got = {r.doc: r.first_doc for r in line_classes(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0}
    # The others share the bucket and are like nothing in it.
    assert len(met) == 1 and len(met[0]) in (0, 2)


def test_buckets_in_any_order_of_members(spark):
    ids = random.Random(4).sample(range(1000), 30)
    rows = [(7, i) for i in ids] + [(8, i) for i in (5, 3, 5)] + [(9, 4), (9, 4), (10, 1)]
    members = spark.createDataFrame(rows, "bucket long, id long")
    for block in (4, 50):
        got = probminhash.bucket_links(members, block).collect()
        assert {(r.bucket, r.id) for r in got if r.bucket != 9} == {(7, i) for i in ids} | {(8, 3), (8, 5)}
        assert all(len({r.leader for r in got if r.bucket == b}) == 1 for b in (7, 8))
        # Blocks of a bucket hang together by the members before.
        chain = {r.id: r.before for r in got if r.bucket == 7}
        assert sum(i == before for i, before in chain.items()) == 1
    plan = probminhash.bucket_links(members)._jdf.queryExecution().executedPlan().toString()
    assert "Sort [bucket" in plan and "id" not in plan.split("Sort [")[1].split("]")[0]


def test_members_are_packed_by_parts():
    ident = np.arange(-3000, 3000)
    bucket = hashing.mix((ident // 3).astype(np.uint64))
    batch = probminhash.packed_members(bucket, ident)
    # Few rows and 12 bytes a member, where a row of two numbers takes more.
    parts = batch.column(0).to_pylist()
    assert len(batch) < 4096 and parts == sorted(set(parts))
    assert sum(len(v) for v in batch.column(1).to_pylist()) == 12 * len(ident)
    blocks = list(probminhash._unpacked(iter([batch])))
    found, who = (np.concatenate([b[k] for b in blocks]) for k in (0, 1))
    assert not any(open_ for _, _, open_ in blocks) and (np.diff(found) >= 0).all()
    together = {}
    for b, i in zip(found.tolist(), who.tolist()):
        together.setdefault(b, set()).add(i)
    assert sorted(map(sorted, together.values())) == [[i, i + 1, i + 2] for i in range(-3000, 3000, 3)]


def test_hashes_of_strings_tell_each_letter():
    import pyarrow as pa

    strings = ["abcd", "abce", "bbcd", "abcé", "abc一", "ab\U0001f600d", "abc\U0001f600"]
    rows = [*strings, "x" + strings[0], "一" + strings[0], "", "abc"]
    made, line = _shingles(pa.array(rows), 4)
    of = [set((made[line == i] >> np.uint64(11)).tolist()) for i in range(len(rows))]
    assert len(set.union(*of[:7])) == 7 and all(len(s) == 1 for s in of[:7])
    # The same string has the same hash in lines of ASCII and in others.
    assert of[0] < of[7] and of[0] < of[8] and of[9] == of[10] == set()
