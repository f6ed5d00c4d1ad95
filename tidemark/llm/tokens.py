"""Token ids of whole texts, with each distinct word encoded once per worker."""

from __future__ import annotations

from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tidemark.llm import hashing

WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")
# Distinct pieces that a worker remembers. If there are more, those that came once are forgotten.
REMEMBERED = 600_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[97:123] = _IS_LETTER[65:91] = True
_IS_STOP = np.zeros(256, bool)
_IS_STOP[[44, 46]] = True


def pieces(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places that no token of the word model crosses: words between ASCII white space, and a comma or full stop
    that ends a word behind a letter. Starts, ends and, per text, the index of its first piece."""
    starts, ends, _ = hashing.word_spans(data, begins)
    last = ends - 1
    # A piece of one byte is left alone; there is nothing before its last byte.
    stop = (last > starts) & _IS_STOP[data[last]] & _IS_LETTER[data[np.maximum(last - 1, 0)]]
    cut = last[stop]
    starts = np.sort(np.append(starts, cut))
    ends = np.sort(np.append(ends, cut))
    return starts, ends, np.searchsorted(starts, begins)


class PieceEncoder:
    """Encodes pieces, and remembers their ids by a hash of their bytes."""

    def __init__(self, model: str):
        self.tokenizer = Tokenizer.from_file(model)
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)
        self.ids = np.zeros(0, np.uint32)

    def _forget_rare(self) -> None:
        """Keep the pieces that have come again since the last time; they begin anew."""
        keep = np.flatnonzero(self.again)
        if len(keep) > REMEMBERED // 2:
            return self.forget()
        count = self.count[keep]
        total = np.append(0, np.cumsum(count))
        take = np.arange(total[-1]) + np.repeat(self.begin[keep] - total[:-1], count)
        self.known, self.count, self.begin, self.ids = self.known[keep], count, total[:-1], self.ids[take]
        self.again = np.zeros(len(keep), bool)

    def _learn(self, hashes: np.ndarray, texts: list[bytes]) -> None:
        made = [e.ids for e in self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]
        count = np.fromiter(map(len, made), np.int64, len(made))
        begin = len(self.ids) + np.cumsum(count) - count
        self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(made), np.uint32, count.sum()))
        at = np.searchsorted(self.known, hashes)
        first = np.zeros(len(hashes), bool)
        self.known, self.begin, self.count, self.again = (
            np.insert(old, at, new)
            for old, new in ((self.known, hashes), (self.begin, begin), (self.count, count), (self.again, first))
        )

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has. Null is empty."""
        data, begins = hashing.flat(texts)
        # The model drops case. Its special tokens are looked for before that.
        if b"<|" not in data.tobytes():
            data = _LOWER[data]
        starts, ends, first = pieces(data, begins)
        distinct, example, at = np.unique(
            hashing.span_hashes(data, starts, ends), return_index=True, return_inverse=True
        )
        if len(self.known) > REMEMBERED:
            self._forget_rare()
        place = np.searchsorted(self.known, distinct)
        new = place == len(self.known)
        new[~new] = self.known[place[~new]] != distinct[~new]
        self.again[place[~new]] = True
        if new.any():
            raw = data.tobytes()
            self._learn(distinct[new], [raw[starts[i] : ends[i]] for i in example[new]])
            place = np.searchsorted(self.known, distinct)
        at = place[at]
        count = self.count[at]
        total = np.append(0, np.cumsum(count))
        take = np.arange(total[-1]) + np.repeat(self.begin[at] - total[:-1], count)
        return self.ids[take], np.diff(total[first])


@cache
def encoder(model: str = WORD_MODEL) -> PieceEncoder:
    """One encoder per worker process."""
    return PieceEncoder(model)
