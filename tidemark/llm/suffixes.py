"""Repeated byte strings by suffix arrays, sorted in two stages.

Recurring passages come from :mod:`tidemark.llm.recurring`, sharded by content. A block of passages
is one text. Only the suffixes that are smaller than their successor are sorted directly. The others
follow from them: a scan over the buckets of first bytes, in order, puts the predecessor of each
suffix at the end of its own bucket. Neighbours in the array with a long enough common prefix are
occurrences of one string.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import hashing
from tidemark.llm.frames import given_id, spread
from tidemark.llm.recurring import Windows, without_later_copies


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the suffix one place later. The empty suffix is the smallest."""
    n = len(text)
    small = np.zeros(n, bool)
    if n < 2:
        return small
    rises, differs = text[:-1] < text[1:], text[:-1] != text[1:]
    # Within a run of one byte, what follows the run decides; the last run falls to the end.
    at = np.where(differs, np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    inner = at < n
    small[:-1][inner] = rises[at[inner]]
    return small


def _order(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Order of places by the ``depth`` bytes from there on: by sixteen first, the rest among equals only."""
    order = np.lexsort((words[at + 8], words[at]))
    at = at[order]
    group = np.ones(len(at), bool)
    group[1:] = (words[at[1:]] != words[at[:-1]]) | (words[at[1:] + 8] != words[at[:-1] + 8])
    alone = group.copy()
    alone[:-1] &= group[1:]
    tied = np.flatnonzero(~alone)
    if len(tied):
        rest = at[tied]
        keys = [words[rest + k] for k in range(16, depth, 8)][::-1] + [np.cumsum(group)[tied]]
        order[tied] = order[tied][np.lexsort(keys)]
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes, in order of their first ``depth`` bytes at least."""
    n = len(text)
    small = smaller_than_next(text)
    direct = np.flatnonzero(small)
    words = np.append(hashing.byte_words(text), np.zeros(depth + 8, np.uint64))
    direct = direct[_order(words, direct, depth)]
    first = text[direct]
    edges = np.searchsorted(first, np.arange(257))
    # Per bucket: the induced suffixes in the order in which the scan meets them.
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n:
        # The end of the text comes before everything, and the last suffix is never smaller than it.
        induced[text[-1]].append(np.array([n - 1]))
    out = []

    def put(suffixes: np.ndarray, bucket: int) -> np.ndarray:
        """Induce the predecessors; returns those of the same bucket."""
        before = suffixes[suffixes > 0] - 1
        before = before[~small[before]]
        letter = text[before]
        order = np.argsort(letter, kind="stable")
        before, letter = before[order], letter[order]
        cuts = np.flatnonzero(np.append(True, letter[1:] != letter[:-1])) if len(letter) else []
        again = before[:0]
        for a, b in zip(cuts, [*cuts[1:], len(letter)]):
            if letter[a] == bucket:
                again = before[a:b]
            else:
                induced[letter[a]].append(before[a:b])
        return again

    for bucket in range(256):
        wave = np.concatenate(induced[bucket]) if induced[bucket] else direct[:0]
        while len(wave):
            out.append(wave)
            wave = put(wave, bucket)
        own = direct[edges[bucket] : edges[bucket + 1]]
        if len(own):
            out.append(own)
            put(own, bucket)
    return np.concatenate(out) if out else direct


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each suffix of the array shares with the one before it, ``depth`` at most."""
    words = np.append(hashing.byte_words(text), np.zeros(depth + 8, np.uint64))
    shared = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for k in range(0, depth, 8):
        if not len(alive):
            break
        apart = words[order[alive] + k] ^ words[order[alive - 1] + k]
        equal = apart == 0
        ended, apart = alive[~equal], apart[~equal]
        alive = alive[equal]
        shared[alive] += 8
        # The number of leading zero bytes of the difference.
        for size in (4, 2, 1):
            zero = apart >> np.uint64(64 - 8 * size) == 0
            shared[ended] += np.where(zero, size, 0)
            apart = np.where(zero, apart << np.uint64(8 * size), apart)
    # Suffixes near the end of the text are shorter than what was compared.
    left = len(text) - order
    shared[1:] = np.minimum(shared[1:], np.minimum(left[1:], left[:-1]))
    return np.minimum(shared, depth)


def with_twins(passages: list[bytes], length: int) -> np.ndarray:
    """Which passages have a string of ``length`` bytes whose hash another one of them has."""
    data, begins = hashing.flat(pa.array(passages, pa.large_binary()))
    times = np.maximum(np.diff(begins) - length + 1, 0)
    starts = spread(begins[:-1], times)
    owner = np.repeat(np.arange(len(passages)), times)
    hashes = hashing.span_hashes(data, starts, starts + length)
    order = np.argsort(hashes)
    again = hashes[order][1:] == hashes[order][:-1]
    twins = np.zeros(len(passages), bool)
    twins[owner[order[1:][again]]] = twins[owner[order[:-1][again]]] = True
    return twins


def locate_strings(length: int):
    """Locate recurring strings of ``length`` bytes in the passages of a shard."""

    def locate(passages: list[bytes], first: np.ndarray, several: np.ndarray):
        # Many passages share an anchor and no more: their suffixes need not be sorted.
        kept = np.flatnonzero(several | with_twins(passages, length))
        if not len(kept):
            return kept, kept, first[:0]
        which, place, least = sort([passages[i] for i in kept], first[kept])
        return kept[which], place, least

    def sort(passages: list[bytes], first: np.ndarray):
        sizes = np.array([len(p) for p in passages])
        # A byte that UTF-8 never has ends the text, so that what follows the end equals nothing.
        text = np.frombuffer(b"".join([*passages, b"\xff"]), np.uint8)
        order = suffix_array(text, length)
        shared = common_prefixes(text, order, length)
        owner = np.repeat(np.arange(len(passages) + 1), np.append(sizes, 1))
        place = np.arange(len(text)) - (np.cumsum(sizes) - sizes)[np.minimum(owner, len(passages) - 1)]
        inside = place + length <= sizes[np.minimum(owner, len(passages) - 1)]
        # A string that runs over the end of its passage is none; the prefix shared by two of its neighbours
        # is long if both prefixes are, as all of a run agree on their first bytes.
        run = np.cumsum(shared < length)
        keep = inside[order]
        order, run = order[keep], run[keep]
        if not len(order):
            return owner[:0], place[:0], first[:0]
        head = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        least = np.minimum.reduceat(first[owner[order]], head)
        count = np.diff(np.append(head, len(order)))
        return owner[order], place[order], np.repeat(least, count)

    return locate


def drop_repeated_strings(docs: DataFrame, length: int = 50, anchor_bytes: int = 18, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes.

    A byte of the UTF-8 text goes if a string of ``length`` bytes over it also begins in a document
    with a smaller id. What is kept may begin or end within a character, so it is binary. Nulls,
    repeated ids and short texts: see :func:`tidemark.llm.recurring.without_later_copies`.
    """
    found = without_later_copies(docs, Windows(length, anchor_bytes, False), locate_strings(length), id_col, text_col)
    return found.select(given_id("doc").alias(id_col), F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", "kept")
