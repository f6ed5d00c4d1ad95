"""Repeated-phrase removal with Aho-Corasick automata.

Recurring passages come from :mod:`tidemark.llm.recurring`, sharded by content. Each shard confirms
which phrases occur in more than one document, compiles an automaton over them, and streams its
passages through it, which gives every occurrence.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import given_id
from tidemark.llm.recurring import Windows, without_later_copies

# Code points below the surrogates and from there on; a shard numbers its words with them.
_GAP_FROM, _GAP = 0xD800, 0x800
_POINTS = 0x110000 - _GAP - 1


def _coded(passages: list[bytes]) -> list[str]:
    """Each word as one character, numbered anew for these passages."""
    numbers: dict[bytes, str] = {}
    out = []
    for passage in passages:
        letters = []
        for word in passage.split(b" "):
            letter = numbers.get(word)
            if letter is None:
                n = len(numbers) + 1
                if n > _POINTS:
                    raise ValueError("a shard has more distinct words than there are characters; use smaller blocks")
                letter = numbers[word] = chr(n if n < _GAP_FROM else n + _GAP)
            letters.append(letter)
        out.append("".join(letters))
    return out


def locate_phrases(length: int):
    """Locate recurring phrases of ``length`` words in the passages of a shard."""

    def locate(passages: list[bytes], first: np.ndarray, _several: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        coded = _coded(passages)
        seen: dict[str, int] = {}
        for text, doc in zip(coded, first.tolist()):
            for i in range(len(text) - length + 1):
                phrase = text[i : i + length]
                if seen.setdefault(phrase, doc) > doc:
                    seen[phrase] = doc
        automaton = ahocorasick.Automaton()
        for phrase, doc in seen.items():
            automaton.add_word(phrase, doc)
        which, place, least = [], [], []
        if len(automaton):
            automaton.make_automaton()
            for n, text in enumerate(coded):
                for end, doc in automaton.iter(text):
                    which.append(n)
                    place.append(end - length + 1)
                    least.append(doc)
        return np.array(which, np.int64), np.array(place, np.int64), np.array(least, np.int64)

    return locate


def drop_repeated_phrases(docs: DataFrame, words: int = 13, anchor_words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``n_words``, ``n_removed`` and the ``kept`` words joined by one space.

    Words are runs without ASCII white space. A word goes if a run of ``words`` words over it also
    begins in a document with a smaller id. Nulls, repeated ids and short texts: see
    :func:`tidemark.llm.recurring.without_later_copies`.
    """
    found = without_later_copies(docs, Windows(words, anchor_words, True), locate_phrases(words), id_col, text_col)
    return found.select(
        given_id("doc").alias(id_col), F.col("n_units").alias("n_words"), "n_removed", F.decode("kept", "UTF-8").alias("kept")
    )
