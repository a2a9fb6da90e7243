"""Word shingles of Arrow text batches as 64-bit hashes, computed over the batch's bytes at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and their bounds (no nulls)."""
    texts = texts.cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lowered, split at ASCII white space) and each text's bounds among them."""
    data, bounds = text_bytes(texts)
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    data = _LOWER[data]
    inside = ~SEPARATORS[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    start[edges] |= inside[edges]
    begin = np.flatnonzero(start)
    if not len(begin):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    letters = data[inside]
    first = np.cumsum(inside)[begin] - 1  # of each word among the letters
    size = np.diff(first, append=len(letters))
    place = np.arange(len(letters)) - np.repeat(first, size)
    powers = np.cumprod(np.full(int(size.max()), _BASE, dtype=np.uint64))
    words = np.add.reduceat(_BYTE[letters] * powers[place], first)
    return mix(words + size.astype(np.uint64)), np.searchsorted(begin, bounds)


def shingle_sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; a text with fewer words has its whole sequence as one."""
    words, bounds = word_hashes(texts)
    n = max(0, len(words) - width + 1)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        total += mix(words[j:j + n] * _PLACE[j] + np.uint64(j))
    total = mix(total + np.uint64(width))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(total[a:b - width + 1]))
        elif b > a:
            one = np.zeros(1, dtype=np.uint64)
            for j in range(b - a):
                one += mix(words[a + j:a + j + 1] * _PLACE[j] + np.uint64(j))
            out.append(mix(one + np.uint64(b - a)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out
