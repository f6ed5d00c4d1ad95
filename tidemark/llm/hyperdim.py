"""Language identification with hyperdimensional profiles.

A letter is a random vector of ones and minus ones. Three letters are bound into one vector: each is
rotated by its place and they are multiplied. A text is the sum of the vectors of its letter
triples, a language the sum over its texts, and the language whose vector has the largest cosine
with the text's is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import column, record, slices
from tidemark.session import stored

DIMENSIONS = 1024
SEED = 20_240_203
UNKNOWN = "und"
# A limit comes from so many texts at least, and is this share of the smallest cosine among them.
LEAST_TEXTS, LIMIT_SHARE = 20, 0.6
# A text's triples have this total weight in its language's profile; whole numbers add up alike in any order.
TEXT_WEIGHT = 1 << 20
HELD_TRIPLES = 100_000
CACHED_TRIPLES = 12_000
MATRIX_CELLS = 1_500_000
_MASK = np.int64((1 << 21) - 1)


@cache
def letter_vector(code: int, dimensions: int, seed: int) -> np.ndarray:
    """The vector of a letter. Zero stands for what is between words."""
    return np.random.default_rng([seed, code]).choice(np.array([-1, 1], np.int8), dimensions)


def triple_vectors(triples: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    out = np.ones((len(triples), dimensions), np.int8)
    for turn, shift in ((2, 42), (1, 21), (0, 0)):
        codes, at = np.unique((triples >> np.int64(shift)) & _MASK, return_inverse=True)
        letters = np.stack([np.roll(letter_vector(int(c), dimensions, seed), turn) for c in codes]) if len(codes) else out
        out *= letters[at]
    return out


class _Triples:
    """Vectors of triples, remembered per worker."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.known, self.vectors = np.zeros(0, np.int64), np.zeros((0, dimensions), np.int8)

    def of(self, triples: np.ndarray) -> np.ndarray:
        """Rows for sorted distinct triples."""
        at = np.searchsorted(self.known, triples)
        hit = at < len(self.known)
        hit[hit] = self.known[at[hit]] == triples[hit]
        made = triple_vectors(triples[~hit], self.dimensions, self.seed)
        out = np.empty((len(triples), self.dimensions), np.int8)
        out[hit], out[~hit] = self.vectors[at[hit]], made
        if len(made) and len(self.known) + len(made) <= CACHED_TRIPLES:
            known = np.append(self.known, triples[~hit])
            order = np.argsort(known)
            self.known, self.vectors = known[order], np.concatenate([self.vectors, made])[order]
        return out


@cache
def _triples(dimensions: int, seed: int) -> _Triples:
    return _Triples(dimensions, seed)


_letter = {0: 0}


def letter_triples(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter triples of all texts and the text of each. Case is dropped, runs of other characters are one gap."""
    lower = [f" {t.lower()} " for t in texts]
    sizes = np.array([len(t) for t in lower])
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    distinct, at = np.unique(codes, return_inverse=True)
    for c in distinct.tolist():
        if c not in _letter:
            _letter[c] = c if chr(c).isalpha() else 0
    codes = np.array([_letter[c] for c in distinct.tolist()], np.int64)[at]
    text = np.repeat(np.arange(len(texts)), sizes)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == 0) & (codes[:-1] == 0) & (text[1:] == text[:-1])
    codes, text = codes[~again], text[~again]
    triples = (codes[:-2] << np.int64(42)) | (codes[1:-1] << np.int64(21)) | codes[2:]
    whole = text[2:] == text[:-2]
    return triples[whole], text[:-2][whole]


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


@dataclass(frozen=True)
class Profiles:
    """Languages in order, a unit vector for each."""

    languages: tuple[str, ...]
    vectors: np.ndarray
    seed: int


def learn_profiles(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED
) -> Profiles:
    """Bundle the texts of each language; every text counts alike, whatever its length.

    Rows without text, letters or language are left out. What comes to the driver is one vector of
    ``dimensions`` numbers per language.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        n = 0

        def bundle() -> None:
            for lang, parts in held.items():
                triples, at = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
                weights = np.zeros(len(triples), np.int64)
                np.add.at(weights, at, np.concatenate([w for _, w in parts]))
                total = sums.setdefault(lang, np.zeros(dimensions, np.int64))
                for a in range(0, len(triples), 1024):
                    vectors = triple_vectors(triples[a : a + 1024], dimensions, seed)
                    total += weights[a : a + 1024] @ vectors.astype(np.int64)
            held.clear()

        for batch in slices(batches, "text"):
            triples, text = letter_triples(column(batch, "text").to_pylist())
            size = np.bincount(text, minlength=batch.num_rows)
            langs = np.array(column(batch, "lang").to_pylist(), object)
            share = TEXT_WEIGHT // np.maximum(size, 1)
            for lang in set(langs):
                mine = langs[text] == lang
                if mine.any():
                    distinct, at = np.unique(triples[mine], return_inverse=True)
                    weights = np.zeros(len(distinct), np.int64)
                    np.add.at(weights, at, share[text[mine]])
                    held.setdefault(lang, []).append((distinct, weights))
                    n += len(distinct)
            if n > HELD_TRIPLES:
                bundle()
                n = 0
        bundle()
        for lang, total in sums.items():
            yield record(lang=pa.array([lang] * dimensions), place=np.arange(dimensions, dtype=np.int32), total=total.astype(np.float64))

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    sums = rows.mapInArrow(work, "lang string, place int, total double")
    # Decimals hold any sum of whole numbers exactly.
    sums = sums.groupBy("lang", "place").agg(F.sum(F.col("total").cast("decimal(30,0)")).alias("total"))
    found = sums.select("lang", "place", F.col("total").cast("double").alias("total")).toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    vectors = np.zeros((len(languages), dimensions))
    vectors[np.searchsorted(languages, found["lang"].to_numpy(str)) if len(found) else [], found["place"].to_numpy(int)] = found["total"]
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Profiles(languages, vectors / np.where(length > 0, length, 1), seed)


def _predict(texts: list[str | None], model: Profiles) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, cosine and number of distinct triples of each text."""
    dimensions = model.vectors.shape[1]
    answer, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    triples, text = letter_triples([t or "" for t in texts])
    size = np.zeros(len(texts), np.int64)
    if not len(triples) or not model.languages:
        return answer, score, size
    distinct, at = np.unique(triples, return_inverse=True)
    vectors = _triples(dimensions, model.seed).of(distinct).astype(np.float32)
    profiles = model.vectors.T.astype(np.float32)
    step = max(1, MATRIX_CELLS // len(distinct))
    for a in range(0, len(texts), step):
        b = min(len(texts), a + step)
        lo, hi = np.searchsorted(text, (a, b))
        counts = np.bincount((text[lo:hi] - a) * len(distinct) + at[lo:hi], minlength=(b - a) * len(distinct))
        counts = counts.reshape(b - a, len(distinct))
        size[a:b] = np.count_nonzero(counts, axis=1)
        bundle = counts.astype(np.float32) @ vectors
        length = np.linalg.norm(bundle, axis=1)
        cosine = bundle @ profiles / np.where(length > 0, length, 1)[:, None]
        best = cosine.argmax(axis=1)
        for i in range(a, b):
            if has_letter(texts[i]):
                answer[i] = model.languages[best[i - a]]
                score[i] = min(1.0, max(0.0, float(cosine[i - a, best[i - a]])))
    return answer, score, size


def predict_language(text: Column | str, model: Profiles) -> Column:
    """A struct of ``lang_pred``, ``score``, the cosine with that language, 0 to 1, and ``n_triples``, the distinct ones.

    A text that is null or has no letter is ``und`` with 0; so is every text if no language was learned.
    """
    @F.pandas_udf("lang_pred string, score double, n_triples long")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        found, held, size = [], [], 0
        for t in [*texts, None]:
            held.append(t)
            size += len(t or "")
            if size > 1 << 17 or len(held) > 1000:
                found.append(_predict(held, model))
                held, size = [], 0
        if held:
            found.append(_predict(held, model))
        answers, scores, sizes = (np.concatenate(x)[:-1] for x in zip(*found))
        return pd.DataFrame({"lang_pred": answers, "score": scores, "n_triples": sizes})

    return predicted(F.col(text) if isinstance(text, str) else text)


def identify_languages(docs: DataFrame, model: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``lang_pred`` and ``score``. Rows are looked at one by one, so repeats and null ids stay."""
    found = docs.select(F.col(id_col), predict_language(F.col(text_col).cast("string"), model).alias("_found"))
    return found.select(id_col, "_found.lang_pred", "_found.score")


def keep_languages(
    docs: DataFrame, model: Profiles, text_col: str = "text", *, learn: Column | None = None, lang_col: str = "lang",
    least_texts: int = LEAST_TEXTS, share: float = LIMIT_SHARE,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language. Texts without letters go.

    With ``learn``, texts that are like no language learned go too. The cosine of a short clean text is as small as that of
    noise, so what is asked for depends on the number of distinct triples: of texts between two powers of two it is ``share`` of
    the smallest cosine among the texts with a language for which ``learn`` holds. Where these are fewer than
    ``least_texts``, it is as for the next smaller size with enough of them, and nothing if there is none. If no language was learned, only texts without letters go.
    """
    if not model.languages:
        return docs.where(F.col(f"`{text_col}`").cast("string").rlike(r"\p{L}"))
    found = predict_language(F.col(f"`{text_col}`").cast("string"), model)
    if learn is None:
        return docs.where(found.getField("lang_pred") != UNKNOWN)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    known = F.coalesce(learn & F.col(f"`{lang_col}`").isNotNull(), F.lit(False)).alias("_learn")
    scored = stored(docs.select(row, found.alias("_found"), known), "languages").where(F.col("_found.lang_pred") != UNKNOWN)
    scored = scored.withColumn("_size", F.floor(F.log2(F.greatest(F.col("_found.n_triples"), F.lit(1)))))
    # A row per power of two comes to the driver.
    least = scored.where("_learn").groupBy("_size").agg(F.min("_found.score").alias("least"), F.count("*").alias("n")).collect()
    known = {r["_size"]: share * r["least"] for r in least if r["n"] >= least_texts}
    limit = F.lit(0.0)
    for size in sorted(known):
        limit = F.when(F.col("_size") >= size, known[size]).otherwise(limit)
    return scored.where(F.col("_found.score") >= limit).select("_row.*")


def remainder(id_col: str, parts: int) -> Column:
    """The fold of a document: a checksum of its id as text."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts
