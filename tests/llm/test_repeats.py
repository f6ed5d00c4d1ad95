from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F
from tests.llm import brute
from tidemark.llm import recurring
from tidemark.llm.frames import bounded, map_packed, packed, record
from tidemark.llm.phrases import drop_repeated_phrases
from tidemark.llm.queries import op6_repeated_phrases, op10_repeated_strings
from tidemark.llm.suffixes import common_prefixes, drop_repeated_strings, smaller_than_next, suffix_array

PASSAGE = " ".join(f"word{i}" for i in range(40))
ROWS = [
    (5, "start " + PASSAGE + " end", 1),
    (2, PASSAGE + " and more", 2),
    (9, "x\ty  " + PASSAGE.replace(" ", "\n"), 3),
    (9, "x\ty  " + PASSAGE.replace(" ", "\n"), 3),
    (9, "another row with the same id: " + PASSAGE[:120], 4),
    (None, "no id " + PASSAGE[20:], 5),
    (None, PASSAGE, 6),
    (7, None, 7),
    (8, "", 8),
    (None, None, None),
    (11, "short", 9),
    (12, "ab" * 2000, 10),
    (13, "ab" * 50 + "é" * 60, 11),
    (14, "é" * 70, 12),
    (15, " ".join(["again"] * 30), 13),
    (16, " ".join(["again"] * 14), 14),
    (17, "nul \0\0 " + "\0" * 60, 15),
    (18, "\0" * 55, 16),
]


def as_rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def frame(spark, rows=ROWS):
    return bounded(spark).createDataFrame(rows, "doc_id long, text string, spans long").repartition(3)


def hashed(df, column):
    return df.withColumn("sha", F.sha2(F.col(column).cast("binary"), 256))


def test_repeats_of_odd_rows(spark):
    docs, plain = frame(spark), [r[:2] for r in ROWS]
    got = hashed(drop_repeated_phrases(docs), "kept")
    assert as_rows(got, "doc_id", "n_words", "n_removed", "sha") == Counter(brute.phrases(plain))
    got = hashed(drop_repeated_strings(docs), "kept")
    assert as_rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == Counter(brute.strings(plain))


def test_empty_table(spark):
    docs = frame(spark, [])
    assert drop_repeated_phrases(docs).count() == 0
    assert drop_repeated_strings(docs).count() == 0


def test_many_documents_share_a_passage(spark):
    from tidemark.llm.phrases import locate_phrases
    from tidemark.llm.recurring import Windows, without_later_copies
    from tidemark.llm.suffixes import locate_strings

    rows = [(i, f"{i} own words {i * 7} " + PASSAGE + f" tail {i}", 0) for i in range(60)]
    docs, plain = frame(spark, rows), [r[:2] for r in rows]
    got = hashed(without_later_copies(docs, Windows(13, 5, True), locate_phrases(13), hot_documents=10), "kept")
    assert as_rows(got, "doc", "n_units", "n_removed", "sha") == Counter(brute.phrases(plain))
    got = hashed(without_later_copies(docs, Windows(50, 18, False), locate_strings(50), hot_documents=10), "kept")
    assert as_rows(got, "doc", "n_units", "n_removed", "n_spans", "sha") == Counter(brute.strings(plain))


def test_whole_table(spark, sf):
    plain = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert as_rows(op6_repeated_phrases(spark, sf), "*") == Counter(brute.phrases(plain))
    assert as_rows(op10_repeated_strings(spark, sf), "*") == Counter(brute.strings(plain))


@pytest.mark.parametrize("letters, size", [(1, 40), (2, 300), (4, 500), (200, 400)])
def test_suffix_array(letters, size):
    text = np.append(np.random.default_rng(size).integers(0, letters, size), 255).astype(np.uint8)
    raw = text.tobytes()
    assert smaller_than_next(text).tolist() == [raw[i:] < raw[i + 1 :] for i in range(len(raw))]
    order = suffix_array(text, 64)
    assert sorted(order) == list(range(len(raw)))
    heads = [raw[i : i + 64] for i in order]
    assert heads == sorted(heads)
    shared = common_prefixes(text, order, 64)
    for a, b, n in zip(order, order[1:], shared[1:]):
        x, y = raw[a:], raw[b:]
        assert n == min(64, next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y))))


@pytest.mark.parametrize("name", ["op6_repeated_phrases", "op10_repeated_strings"])
def test_sql(spark, sf, name):
    from tools.check import compare, database

    status, said = compare(spark, database(sf), sf, name)
    assert status == "ok" and "types" not in said, said


def test_anchors_name_texts_by_their_smallest_id(spark, monkeypatch):
    sent = []
    before = recurring._recurring

    def seen(rows, hot):
        sent.append({r.who for r in rows.select("who").distinct().collect()})
        return before(rows, hot)

    monkeypatch.setattr(recurring, "_recurring", seen)
    # A copy sends nothing; only texts that share their smallest id are named by a hash.
    rows = [(1, PASSAGE), (2, "a " + PASSAGE), (3, PASSAGE), (4, "x" * 60), (4, "y" * 60), (None, "b " + PASSAGE)]
    got = hashed(drop_repeated_strings(frame(spark, [(*r, 0) for r in rows])), "kept")
    assert as_rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == Counter(brute.strings(rows))
    assert {1, 2, (1 << 63) - 1} < sent[0] and len(sent[0]) == 5 and not {3, 4} & sent[0]


def test_packed_texts(spark):
    rows = [("", 1), ("é\0", 2), ("ab" * 900_000, 3), (PASSAGE * 300, 4)]
    held = packed(bounded(spark).createDataFrame(rows, "text string, n long"), "text")
    assert held.where("n = 3").selectExpr("length(text) < 1000").first()[0]
    most = lambda b: record(n=b.column("n"), back=b.column("text"), rows=np.full(b.num_rows, b.num_rows))
    got = {r.n: (bytes(r.back).decode(), r.rows) for r in map_packed(held.coalesce(1), "text", most, "n long, back binary, rows long").collect()}
    # Cut by the size before packing: a long text is a piece of its own.
    assert {n: b for n, (b, _) in got.items()} == {n: t for t, n in rows} and got[3][1] == 1


def test_neighbouring_windows_are_looked_up_once():
    import pyarrow as pa

    from tidemark.llm.recurring import Windows

    windows = Windows(50, 18, False)
    texts = ["", "short", PASSAGE, "x" * 49, "y" * 50, "", PASSAGE[::-1] * 3, ""]
    units = windows.units(pa.array(texts, pa.string()))
    anchor, text, place, size = windows.anchors(units)
    # Each window lies in one run, and runs are few.
    own = [(t, p + i) for t, p, n in zip(text, place - units.first[text], size) for i in range(n)]
    assert own == [(t, i) for t, s in enumerate(texts) for i in range(len(s) - 49)]
    assert len(anchor) < len(own) / 5
    alone = windows.anchors(windows.units(pa.array([PASSAGE], pa.string())))
    assert alone[0].tolist() == anchor[text == 2].tolist() and alone[3].tolist() == size[text == 2].tolist()


def test_passages_without_a_twin_are_not_sorted(monkeypatch):
    from tidemark.llm import suffixes

    sorted_bytes = []
    array = suffixes.suffix_array
    monkeypatch.setattr(suffixes, "suffix_array", lambda text, depth: sorted_bytes.append(len(text)) or array(text, depth))
    anchor = b"eighteen letters__"
    own = [bytes([65 + i]) * 32 + anchor + bytes([97 + i]) * 32 for i in range(20)]
    twins = [b"before" + own[3][:50], own[3] + b"behind"]
    locate = suffixes.locate_strings(50)
    several = np.zeros(22, bool)
    which, place, least = locate(own[:3] + own[4:] + twins, np.arange(21), several[:21])
    # The twins share the 50 bytes from the first on, and 50 bytes are all that the first has behind the six before.
    assert sorted_bytes == [sum(map(len, twins)) + 1]
    assert (19, 6, 19) in set(zip(which, place, least)) and (20, 0, 19) in set(zip(which, place, least))
    # A passage of several documents is located though no other one is like it.
    several[5] = True
    assert set(locate(own, np.arange(20), several[:20])[0]) == {5}
    assert not len(locate(own, np.arange(20), several[:20] & False)[0])
