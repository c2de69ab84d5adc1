"""Word shingles of whole texts, vectorised over the bytes of an Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: The first n bytes of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Words of more bytes are hashed one by one.
_LONG = 256


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def words(texts: pa.Array, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts with A-Z in lower case, where each word starts and ends in them, and where each text's words start.

    A word is a run of characters outside ``[\\x20\\x09-\\x0D]`` within one text, or outside the bytes that ``outside`` marks.
    """
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    text = _LOWER[np.frombuffer(data, np.uint8)[at[0] : at[-1]]] if data else np.zeros(0, np.uint8)
    at = at - at[0]
    inside = ~outside[text]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    some = at[1:] > at[:-1]
    first[at[:-1][some]] = inside[at[:-1][some]]
    last[at[1:][some] - 1] = inside[at[1:][some] - 1]
    starts = np.flatnonzero(first)
    return text, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def word_hashes(texts: pa.Array, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and where each text's words start."""
    text, starts, ends, offsets = words(texts, outside)
    size = ends - starts
    h = mixed(size.astype(np.uint64) * _STEP)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(text) + 1, "<u8", padded.data, 0, (1,))
    todo = np.flatnonzero(size <= _LONG)
    k = 0
    while len(todo):
        part = eight[starts[todo] + k] & _FIRST[np.minimum(size[todo] - k, 8)]
        h[todo] = mixed(h[todo] ^ part) + _STEP
        k += 8
        todo = todo[size[todo] > k]
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(text[starts[i] : ends[i]].tobytes())
    return h, offsets


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """For each text its distinct shingles of ``size`` words as sorted 64-bit hashes.

    A text of fewer words is one shingle of all its words; a text without words has none.
    Two different shingles get one hash with a probability of about 2**-64.
    """
    h, offsets = word_hashes(texts)
    n = len(h)
    rolled = np.zeros(n, np.uint64)
    for k in range(min(size, n)):
        rolled *= _STEP
        rolled[: n - k] += h[k:]
    rolled = mixed(rolled)
    out = []
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if hi - lo >= size:
            x = np.sort(rolled[lo : hi - size + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif hi > lo:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[lo:hi].tobytes(), seed=hi - lo)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
