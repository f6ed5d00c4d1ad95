import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import hashing, packing, tokens
from tidemark.llm.frames import bounded
from tidemark.llm.packing import TIERS, pack, pack_documents, step_groups
from tidemark.llm.queries import op1_hierarchical_packing
from tidemark.llm.tokens import WORD_MODEL, encoder


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 6000), max_size=60))
def test_pack_places_every_id_once(lengths):
    windows, rest = pack(lengths)
    assert sum(p[2] for p in rest) < TIERS[0]
    seen = defaultdict(list)
    for tier, pieces in windows:
        assert sum(p[2] for p in pieces) == tier
        for doc, start, n in pieces:
            seen[doc].append((start, n))
    for doc, start, n in rest:
        seen[doc].append((start, n))
    for doc, total in enumerate(lengths):
        at = 0
        for start, n in sorted(seen[doc]):
            assert start == at and n > 0
            at += n
        assert at == total


def test_step_groups_are_balanced():
    windows, _ = pack(list(np.random.default_rng(1).integers(1, 3000, 3000)))
    groups = step_groups(windows, 8 * 2048)
    by = defaultdict(list)
    for (tier, pieces), g in zip(windows, groups):
        by[g].append((tier, sum(p[2] ** 2 for p in pieces)))
    full = [v for v in by.values() if sum(t for t, _ in v) == 8 * 2048]
    assert all(len({t for t, _ in v}) == 1 for v in by.values())
    assert len(full) > 0.8 * len(by)
    spread = [max(c for _, c in v) / min(c for _, c in v) for v in full]
    assert np.median(spread) < 1.2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aé̀ß ΣσİI'st1\x1c\xa0\x85\n\t.<|endoftext|>日本"), max_size=40), max_size=8))
def test_pieces_give_the_ids_of_whole_texts(texts):
    plain = Tokenizer.from_file(WORD_MODEL)
    ids, counts = encoder().encode(pa.array(texts, pa.string()))
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def check(rows, docs):
    """docs: list of (id, text)."""
    plain = Tokenizer.from_file(WORD_MODEL)
    want = [(i, (*plain.encode(t or "", add_special_tokens=False).ids, 1)) for i, t in docs]
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    for (i, n), pieces in by_doc.items():
        mine = [ids for d, ids in want if d == i and len(ids) == n]
        assert len(mine) and sum(r["length"] for r in pieces) == n * len(mine)
        for r in pieces:
            cut = [np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes() for ids in mine]
            assert r["ids_crc32"] in [zlib.crc32(c) for c in cut]
    assert sum(len(ids) for _, ids in want) == sum(r["length"] for r in rows)
    return padding


def test_packing_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "POOL_TOKENS", 3000)
    docs = [(1, None), (2, ""), (3, " \n "), (None, "no id"), (None, None), (4, "word " * 9000), (5, "same"), (5, "same"), (6, "x" * 5000)]
    df = bounded(spark).createDataFrame([(*d, 3) for d in docs], "doc_id long, text string, start long").repartition(4)
    rows = pack_documents(df).selectExpr("*", "crc32(ids) ids_crc32").collect()
    check([r.asDict() for r in rows], docs)
    assert pack_documents(df.limit(0)).count() == 0


def test_packing_of_the_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = [r.asDict() for r in op1_hierarchical_packing(spark, sf).collect()]
    assert check(rows, docs) <= 2048


@pytest.mark.parametrize("most", [5, 40, 1000])
def test_encoder_forgets_rare_pieces_only(monkeypatch, most):
    monkeypatch.setattr(tokens, "REMEMBERED", most)
    made, pick = tokens.PieceEncoder(tokens.WORD_MODEL), random.Random(3)
    common = ["the", "of", "a", "Straße,", "end."]
    for n in range(12):
        texts = [" ".join(pick.choice(common) if pick.random() < 0.7 else f"w{pick.randrange(10**6)}x" for _ in range(30)) for _ in range(4)] + [None, ""]
        ids, count = made.encode(pa.array(texts, pa.string()))
        want = [made.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert count.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
        assert n < 2 or most < 1000 or made.again.sum() >= len(common)


def test_words_that_every_polynomial_takes_for_equal():
    """The Thue-Morse word and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    words = ["".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)]
    made = tokens.PieceEncoder(tokens.WORD_MODEL)
    for texts in ([words[0], words[1]], [words[1]], [words[0]]):
        ids, count = made.encode(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in made.tokenizer.encode(t, add_special_tokens=False).ids]
    data, begins = hashing.flat(pa.array(words))
    for seed in (0, 0x5DEECE66D):
        assert len(set(hashing.span_hashes(data, begins[:-1], begins[1:], seed).tolist())) == 2
