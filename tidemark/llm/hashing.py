"""Hashes of words, shingles and byte strings, computed for many texts at once on flat arrays.

All arithmetic is on unsigned 64-bit numbers and wraps around. The hashes depend on the
content alone, so every task and every run agrees on them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

# Polynomials modulo 2^64 have collisions that hold for every base, between texts of 1,024 bytes and more. Spans from this
# length on get a hash of another kind.
LONG_SPAN = 256
_ONE = np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a number over all bits; one to one."""
    h = np.asarray(h, np.uint64)
    out, spare = h ^ (h >> np.uint64(30)), np.empty_like(h)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= np.right_shift(out, np.uint64(27), out=spare)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= np.right_shift(out, np.uint64(31), out=spare)
    return out


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _grown(name: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        run = np.full(max(n, 1 << 16), base, np.uint64)
        run[0] = _ONE
        _powers[name] = np.cumprod(run)
    return _powers[name][:n]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (one entry more than texts). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    begins = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[begins[0] : begins[-1]], begins - begins[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of each byte range."""
    sums = np.zeros(len(data) + 1, np.uint64)
    table = mix(_BYTE + np.uint64(seed))
    np.cumsum(table[data] * _grown("up", _BASE, len(data)), out=sums[1:])
    down = _grown("down", _BASE_INVERSE, len(data) + 1)
    out = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    long = np.flatnonzero(ends - starts >= LONG_SPAN)
    if len(long):
        raw = memoryview(np.ascontiguousarray(data))
        out[long] = [xxhash.xxh3_64_intdigest(raw[a:b], seed) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
    return out


# Space, tab, line feed, vertical tab, form feed, carriage return.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_spans(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of other bytes than ASCII white space: start, end and, per text, the index of its first word."""
    solid = ~_IS_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[begins] = True
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | first[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, begins)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` consecutive hashes."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for i in range(n):
        out = mix(out * _BASE + hashes[i : len(out) + i])
    return out


def byte_words(data: np.ndarray) -> np.ndarray:
    """At each place the next eight bytes as a number whose order is the order of the bytes; zeros follow the end."""
    wide = np.zeros(len(data) + 8, np.uint64)
    wide[: len(data)] = data
    for step in (1, 2, 4):
        shifted = np.zeros_like(wide)
        shifted[:-step] = wide[step:]
        wide = (wide << np.uint64(8 * step)) | shifted
    return wide[: len(data)]


def byte_shingles(data: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` bytes, ``n`` from 8 to 16 or above."""
    words = byte_words(data)
    size = max(0, len(data) - n + 1)
    out = mix(words[:size])
    at = 8
    while at < n:
        at = min(at, n - 8)
        out = mix(out * _BASE + words[at : at + size])
        at += 8
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each run of ``width`` values."""
    size, have = len(values) - width + 1, 1
    if size <= 0:
        return values[:0]
    out = values
    while have * 2 <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    return out if have == width else np.minimum(out[:size], out[width - have : width - have + size])
