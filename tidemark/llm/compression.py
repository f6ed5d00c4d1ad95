"""Toxicity by compression distance.

Two zstandard dictionaries are trained. The ordinary one comes from ordinary text. The toxic one has
the same content and, where it is cheapest to point at, the pieces that are typical of toxic text
and rare in ordinary text; the ordinary one is padded there. So a window without such pieces has
the same length with both, and what is left is signal. A text is cut into short windows, each is compressed with both, and the
bytes that the toxic dictionary saves are its evidence. The threshold of a window, the weights of
the evidence and the threshold of a text are calibrated on labelled texts that the dictionaries
have not seen.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_BYTES = 200
COMMON_BYTES = 32_000
OWN_BYTES = 512
LEVEL, MIN_MATCH, WINDOW_LOG = 6, 3, 17
# At most so many labelled texts of a class are learned from, and none longer than this.
SAMPLE_TEXTS = 4000
SAMPLE_CHARS = 100_000
# A typical piece is the beginning of a word, in so many texts, and so many times likelier in its class.
PIECE_BYTES = range(5, 15)
LEAST_TEXTS, LEAST_RATIO = 5, 6.0
WINDOW_THRESHOLDS = (1, 2, 3, 4, 5, 6)


def normal(text: str | None) -> bytes:
    return re.sub(r"\s+", " ", f" {(text or '').lower()} ").encode("utf-8", "replace")


def windows(text: bytes, size: int) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)]


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    window_threshold: int
    weights: tuple[float, ...]
    bias: float


@cache
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters.from_level(LEVEL, window_log=WINDOW_LOG, min_match=MIN_MATCH, write_content_size=False)
    trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(compression_params=how, dict_data=trained)


def savings(text: bytes, toxic: bytes, ordinary: bytes) -> np.ndarray:
    """Bytes that the toxic dictionary saves over the ordinary one, by window."""
    with_toxic, with_ordinary = _compressor(toxic), _compressor(ordinary)
    return np.array([len(with_ordinary.compress(w)) - len(with_toxic.compress(w)) for w in windows(text, WINDOW_BYTES)])


def evidence(saved: np.ndarray, threshold: int) -> list[float]:
    over = saved >= threshold
    return [float(saved.mean()), float(over.mean()), math.log1p(over.sum()), float(np.clip(saved.max(), 0, 20)) / 4]


def _pieces(text: bytes) -> set[bytes]:
    return {f[:n] for w in set(text.split(b" ")) for f in (b" " + w + b" ",) for n in PIECE_BYTES if n <= len(f)}


def typical(own: list[bytes], other: list[bytes]) -> list[bytes]:
    """Pieces of one class, most useful first."""
    mine: Counter[bytes] = Counter()
    for i in range(0, len(own), 500):
        for text in own[i : i + 500]:
            mine.update(_pieces(text))
        if len(mine) > 2_000_000:  # what is still rare then is forgotten
            mine = Counter({p: n for p, n in mine.items() if n > 1})
    mine = Counter({p: n for p, n in mine.items() if n >= LEAST_TEXTS})
    theirs: Counter[bytes] = Counter()
    for text in other:
        theirs.update(_pieces(text) & mine.keys())
    odds = {p: math.log((n + 0.5) / (len(own) + 1)) - math.log((theirs[p] + 0.5) / (len(other) + 1)) for p, n in mine.items()}
    chosen = {p: n * odds[p] for p, n in mine.items() if odds[p] > math.log(LEAST_RATIO)}
    # A piece that nearly always goes on the same way is covered by the longer one.
    for piece in list(chosen):
        if (shorter := piece[:-1]) in chosen and mine[piece] >= 0.6 * mine[shorter]:
            chosen.pop(shorter)
    return sorted(chosen, key=lambda p: (-chosen[p], p))


def _own_part(pieces: list[bytes], size: int) -> bytes:
    """The most useful pieces last, where they are cheapest to point at."""
    taken, length = [], 0
    for piece in pieces:
        if any(piece in t for t in taken):
            continue
        if length + len(piece) > size:
            break
        taken.append(piece)
        length += len(piece)
    return b"".join(taken[::-1])


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """Dictionaries of equal length, so that a window that neither class's own part helps has equal sizes."""
    whole = b"".join(ordinary)
    pick = np.random.default_rng(1).integers(0, max(1, len(whole) - 400), 6000)
    samples = [whole[i : i + 400] for i in pick.tolist()]
    try:
        common = zstandard.train_dictionary(COMMON_BYTES, samples, k=64, d=8, threads=1).as_bytes()[-COMMON_BYTES:]
    except zstandard.ZstdError:  # too little text
        common = whole[-COMMON_BYTES:]
    own = _own_part(typical(toxic, ordinary), OWN_BYTES)
    # Bytes that no text has. Pieces of ordinary text here would add noise to all windows.
    return common + own, common + b"\xff" * len(own)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights and bias by Newton steps, with a little ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([*np.full(x.shape[1] - 1, 1e-2), 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_texts: int = SAMPLE_TEXTS, sample_chars: int = SAMPLE_CHARS,
) -> Model | None:
    """Learn from labelled documents: those of ``sample_texts`` ids of each class at most, the ids with the smallest
    hash, no text longer than ``sample_chars``. Null ids, null labels, ids with both labels and null texts are
    left out. None if either class has fewer than four texts.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_toxic"), F.min(label_col).alias("_least"))
    known = known.where("_toxic = _least").select("_id", "_toxic")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).where("_text is not null")
    count = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    sets = []
    for label in (1, 0):
        # At most so many ids, so that they can be sent to where the texts are.
        ids = known.where(F.col("_toxic") == label).select("_id").orderBy(F.xxhash64("_id"), "_id").limit(sample_texts)
        rows = texts.where(F.length("_text") <= sample_chars).join(F.broadcast(ids), "_id").dropDuplicates(["_id"])
        rows = rows.orderBy(F.xxhash64("_id"), "_id").select("_text").collect()
        sets.append([normal(r["_text"]) for r in rows])
    if min(map(len, sets)) < 4:
        return None
    # Two of three texts make the dictionaries, the third ones the thresholds.
    toxic, ordinary = train_dictionaries(*[[t for i, t in enumerate(s) if i % 3] for s in sets])
    saved = [[savings(t, toxic, ordinary) for t in s[::3]] for s in sets]
    y = np.repeat([1.0, 0.0], [len(s) for s in saved])
    share = count[1] / (count[0] + count[1])
    weight = np.where(y == 1, share / len(saved[0]), (1 - share) / len(saved[1])) * len(y)
    best = None
    for threshold in WINDOW_THRESHOLDS:
        x = np.array([evidence(s, threshold) for group in saved for s in group])
        w = _logistic(x, y, weight)
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        loss = -(weight * np.log(np.clip(np.where(y == 1, p, 1 - p), 1e-9, 1))).sum()
        if best is None or loss < best[0]:
            best = loss, threshold, w, x
    _, threshold, w, x = best
    # A text's threshold is where the harmonic mean of precision and recall is best; the score is 0.5 there.
    margin = x @ w[:-1] + w[-1]
    order = np.argsort(-margin)
    hits = np.cumsum((weight * y)[order])
    f1 = 2 * hits / (np.cumsum(weight[order]) + (weight * y).sum())
    at = int(f1.argmax())
    cut = margin[order[at]] if at + 1 == len(order) else (margin[order[at]] + margin[order[at + 1]]) / 2
    return Model(toxic, ordinary, threshold, tuple(map(float, w[:-1])), float(w[-1] - cut))


def toxicity(text: Column | str, model: Model | None) -> Column:
    """Score of each text, 0 to 1; 0.5 is the calibrated threshold. A null text is scored as an empty one;
    without a model every score is 0."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series(np.zeros(len(texts)))
        weights = np.array(model.weights)
        out = []
        for text in texts:
            x = evidence(savings(normal(text), model.toxic, model.ordinary), model.window_threshold)
            out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, float(weights @ x) + model.bias)))))
        return pd.Series(out, dtype=float)

    return scored(F.col(text) if isinstance(text, str) else text)
