"""Vectorised 64-bit hashes of words and word shingles over Arrow string buffers.

All arithmetic wraps modulo 2**64.  A word's hash is a polynomial over random byte codes,
finished by a mixer; it depends on nothing but the word's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
_CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
#: Bytes handled at once, so that the temporary arrays stay small.
SPAN_BYTES = 1 << 20


def lower_table() -> np.ndarray:
    """Byte map that lower-cases A-Z alone."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_table()
#: Separators of the word class [^\x20\x09-\x0D]+.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    if n > 1:
        np.multiply.accumulate(np.full(n - 1, base, np.uint64), out=out[1:])
    return out


def powers(base: np.uint64, n: int) -> np.ndarray:
    return _powers(int(base), 1 << max(6, int(n).bit_length()))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string array; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def spans(offsets: np.ndarray, limit: int = SPAN_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of documents of about `limit` bytes; a longer document is a run of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def words(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the documents raw[offsets[i]:offsets[i + 1]], and where each document's words begin (n + 1)."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    if hi == lo:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    text = LOWER[raw[lo:hi]]
    inside = ~separators[text]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]] - lo
    begins[heads] = inside[heads]
    counts = np.zeros(hi - lo + 1, np.int64)
    np.cumsum(begins, out=counts[1:])
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    where = np.arange(hi - lo)
    place = where - starts[np.maximum(counts[1:] - 1, 0)]
    place[: starts[0]] = 0
    terms = _CODES[text] * powers(_BASE, int(place.max()) + 1)[place]
    terms[~inside] = 0
    return mix(np.add.reduceat(terms, starts)), counts[offsets - lo]


def shingles(hashes: np.ndarray, begins: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles, and where each document's begin; fewer words, but not none, are one shingle."""
    n = np.diff(begins)
    whole = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    to = np.zeros(len(begins), np.int64)
    np.cumsum(whole, out=to[1:])
    if not to[-1]:
        return np.zeros(0, np.uint64), to
    first = np.repeat(begins[:-1] - to[:-1], whole) + np.arange(to[-1])
    last = np.repeat(begins[1:], whole)
    out = np.zeros(to[-1], np.uint64)
    step = powers(_STEP, k)
    for j in range(k):
        at = first + j
        fits = at < last
        out += np.where(fits, hashes[np.where(fits, at, 0)], np.uint64(0)) * step[j]
    return mix(out + np.repeat(np.minimum(n, k).astype(np.uint64), whole)), to


def shingle_sets(texts: pa.Array, k: int, separators: np.ndarray = BLANK) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    raw, offsets = buffers(texts)
    for a, b in spans(offsets):
        hashes, to = shingles(*words(raw, offsets[a : b + 1], separators), k)
        for i in range(b - a):
            yield np.unique(hashes[to[i] : to[i + 1]])
