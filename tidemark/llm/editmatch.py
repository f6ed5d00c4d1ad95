"""Test items found in documents within a budget of edits.

A match with at most ``e`` edits leaves one of any ``e + 1`` pieces of the item untouched. An
automaton over all pieces finds their exact hits, and around each hit Myers' bit-parallel algorithm
computes the edit distance of the item to the best part of the document. Two exact conditions drop
most chance hits before that. Counted round the item, errors less pieces are below zero, so from one
of the untouched pieces on all running sums are below zero too: the piece behind it has one edit at
most. And a part within the budget shares enough letter groups with the item.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Edits allowed for each character of an item.
BUDGET = 0.1
# Shorter items would match by chance: they may have no edits and must stand between words. Of less than the second number
# are words and short phrases that clean texts have too.
LEAST_CHARS, SHORTEST = 32, 8
GROUP = 4
# Characters of items in one automaton; more items are looked for in several passes.
BLOCK_CHARS = 2_000_000


def plain(text: Column) -> Column:
    """Letters and digits in lower case, with one space for everything between them."""
    return F.trim(F.regexp_replace(F.lower(text.cast("string")), r"[^\p{L}\p{N}]+", " "))


def best_distance(masks: dict[str, int], length: int, text: str) -> int:
    """The smallest edit distance of an item to any part of ``text``; ``masks`` has the places of each character."""
    full, high = (1 << length) - 1, 1 << (length - 1)
    up, down, score, best = full, 0, length, length
    for c in text:
        equal = masks.get(c, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        grow, shrink = down | (full & ~(horizontal | up)), up & horizontal
        if grow & high:
            score += 1
        elif shrink & high:
            score -= 1
            if score < best:
                best = score
        grow, shrink = (grow << 1) & full, (shrink << 1) & full
        up, down = shrink | (full & ~(vertical | grow)), grow & vertical
    return best


def begins_nearly(text: str, at: int, piece: str) -> bool:
    """Whether the text goes on at ``at`` with the piece, but for one edit at most."""
    if text.startswith(piece, at):
        return True
    i, most = 0, min(len(piece), len(text) - at)
    while i < most and piece[i] == text[at + i]:
        i += 1
    rest = piece[i + 1 :]
    return text.startswith(rest, at + i + 1) or text.startswith(rest, at + i) or text.startswith(piece[i:], at + i + 1)


def item_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    return masks


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of nearly equal length and where they begin."""
    n = errors + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


@dataclass(frozen=True)
class Items:
    """Distinct plain items, the ids of each, and the share of edits allowed."""

    texts: tuple[str, ...]
    ids: tuple[tuple[int | None, ...], ...]
    budget: float
    least_chars: int = LEAST_CHARS

    def is_short(self, n: int) -> bool:
        return len(self.texts[n]) < self.least_chars

    def errors(self, n: int) -> int:
        return 0 if self.is_short(n) else math.floor(self.budget * len(self.texts[n]))


class _Finder:
    def __init__(self, items: Items):
        self.items = items
        places: dict[str, list[tuple[int, int, str | None]]] = {}
        for n, text in enumerate(items.texts):
            cut = pieces(text, items.errors(n))
            for (at, piece), (_, behind) in zip(cut, [*cut[1:], (0, None)]):
                places.setdefault(piece, []).append((n, at, behind))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.masks = [item_masks(t) for t in items.texts]
        self.groups = [[t[i : i + GROUP] for i in range(len(t) - GROUP + 1)] for t in items.texts]
        self.least = [len(g) - GROUP * items.errors(n) for n, g in enumerate(self.groups)]

    def _ranges(self, n: int, starts: list[int], size: int) -> list[tuple[int, int]]:
        """Parts of the document around hits of an item, joined where they overlap."""
        slack, length = self.items.errors(n), len(self.items.texts[n])
        out: list[tuple[int, int]] = []
        for start in sorted(set(starts)):
            a, b = max(0, start - slack), min(size, start + length + slack)
            if out and a <= out[-1][1]:
                out[-1] = out[-1][0], b
            else:
                out.append((a, b))
        return out

    def find(self, text: str) -> list[tuple[int, int]]:
        """Items in the text and their distances."""
        hits: dict[int, list[int]] = {}
        if len(self.automaton):
            for end, (size, where) in self.automaton.iter(text):
                for n, at, behind in where:
                    if behind is not None and not begins_nearly(text, end + 1, behind):
                        continue
                    if self.items.is_short(n) and (text[end + 1 : end + 2].strip() or text[max(0, end - size) : end + 1 - size].strip()):
                        continue
                    hits.setdefault(n, []).append(end + 1 - size - at)
        found = []
        for n, starts in hits.items():
            errors, best = self.items.errors(n), None
            for a, b in self._ranges(n, starts, len(text)):
                part = text[a:b]
                have = {part[i : i + GROUP] for i in range(len(part) - GROUP + 1)}
                if sum(g in have for g in self.groups[n]) < self.least[n]:
                    continue
                distance = best_distance(self.masks[n], len(self.items.texts[n]), part)
                if distance <= errors and (best is None or distance < best):
                    best = distance
            if best is not None:
                found.append((n, best))
        return found


@cache
def _finder(items: Items) -> _Finder:
    return _Finder(items)


def item_blocks(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", budget: float = BUDGET,
    least_chars: int = LEAST_CHARS, block_chars: int = BLOCK_CHARS, shortest: int = SHORTEST,
) -> list[Items]:
    """Items in blocks of about ``block_chars`` characters, so that an automaton is of bounded size."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), plain(F.col(text_col)).alias("text"))
    items = items.where(F.length("text") >= shortest)
    total = items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = math.ceil(total / block_chars)
    out = []
    for block in range(blocks):
        # All items with one text are in one block.
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        by_text: dict[str, list[int | None]] = {}
        for r in rows:
            by_text.setdefault(r["text"], []).append(r["id"])
        texts = tuple(sorted(by_text))
        out.append(Items(texts, tuple(tuple(sorted(by_text[t], key=lambda i: (i is None, i))) for t in texts), budget, least_chars))
    return out


_FOUND = "array<struct<item_id: bigint, distance: int, item_chars: int>>"


def _matches(text: Column, items: Items) -> Column:
    @F.pandas_udf(_FOUND)
    def matched(texts: pd.Series) -> pd.Series:
        finder = _finder(items)
        return pd.Series(
            [
                [
                    {"item_id": i, "distance": d, "item_chars": len(items.texts[n])}
                    for n, d in (finder.find(t) if t else [])
                    for i in items.ids[n]
                ]
                for t in texts
            ]
        )

    return matched(text)


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """One row per document and item in it: id, ``item_id``, the smallest ``distance`` and the item's ``item_chars``.

    Distances are edits between plain texts: letters and digits in lower case, single spaces. An item
    of ``n`` characters may have ``floor(budget * n)``; one under ``least_chars`` characters none, and it
    must stand between words. Items under ``shortest`` characters, null ones too, match nothing. Null and empty documents have no matches. Repeated rows, null ids and
    items with equal texts are each reported.
    """
    text = plain(F.col(text_col)).alias("_plain")
    none = docs.select(F.col(id_col), F.explode(F.array().cast(_FOUND)).alias("_found")).limit(0)
    for items in item_blocks(benchmark, **options):
        rows = docs.select(F.col(id_col), text).select(F.col(id_col), _matches(F.col("_plain"), items).alias("_all"))
        none = none.unionByName(rows.select(id_col, F.explode("_all").alias("_found")))
    return none.select(id_col, "_found.item_id", "_found.distance", "_found.item_chars")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found."""
    for items in item_blocks(benchmark, **options):
        docs = docs.where(F.size(_matches(plain(F.col(f"`{text_col}`")), items)) == 0)
    return docs
