"""Word shingles of Arrow text batches as 64-bit hashes, by numpy over the bytes.

A word's hash is a polynomial of its bytes, a shingle's hash mixes its words' hashes. All
texts of a batch are hashed at once, in slices bounded by bytes, so memory follows the slice
and the longest single text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SLICE_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, _BASE, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def word_hashes(data: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word; A-Z count as lower case.

    Words also begin at ``breaks``, where one text follows another.
    """
    inside = _IS_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    if breaks is not None:
        breaks = breaks[breaks < len(data)]
        begins[breaks] = inside[breaks]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, np.uint64), at
    first = np.flatnonzero(begins[at])
    lengths = np.diff(np.append(first, len(at)))
    within = np.arange(len(at)) - np.repeat(first, lengths)
    terms = (_LOWER[data[at]].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[within]
    return mixed(np.add.reduceat(terms, first)), at[first]


def shingles_of(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text's word hashes; a text shorter than a
    shingle has its whole sequence as the only one."""
    n = min(size, len(words))
    if n == 0:
        return np.empty(0, np.uint64)
    count = len(words) - n + 1
    h = words[:count].copy()
    for i in range(1, n):
        h = mixed(h * np.uint64(3) + words[i : i + count])
    return np.unique(h)


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + _SLICE_BYTES, side="right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each; null texts are empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The shingle set of every text, in order."""
    if not len(texts):
        return
    data, offsets = text_bytes(texts)
    for first, last in _slices(offsets):
        base = offsets[first]
        bounds = offsets[first : last + 1] - base
        hashes, starts = word_hashes(data[base : offsets[last]], bounds[:-1])
        at = np.searchsorted(starts, bounds)
        for i in range(last - first):
            yield shingles_of(hashes[at[i] : at[i + 1]], size)
