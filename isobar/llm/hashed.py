"""Vectorised word and window hashes over Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RANDOM = np.random.Generator(np.random.PCG64(20240601))
#: A random number for each byte at each place in a word; words longer than 64 bytes go on with the powers of an odd number.
_BYTES = _RANDOM.integers(0, 1 << 64, (64, 256), dtype=np.uint64)
_LONG = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of text that are taken at once (a longer text is taken alone).
PIECE = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about PIECE bytes of text each."""
    n = len(texts)
    size = np.diff(_offsets(texts))
    start = total = 0
    for i in range(n):
        total += int(size[i])
        if total >= PIECE:
            yield start, i + 1
            start, total = i + 1, 0
    if start < n:
        yield start, n


def _offsets(texts: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(texts.type)
    return np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one text after the other, and for n texts the n + 1 borders in them; nulls have no words."""
    offsets = _offsets(texts)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    data = _LOWER[data] if lower else data
    offsets = offsets - offsets[0]
    inside = ~_SPACES[data]
    if texts.null_count:
        for i in np.flatnonzero(texts.is_null().to_numpy(zero_copy_only=False)):
            inside[offsets[i] : offsets[i + 1]] = False
    before = np.empty(len(data), bool)  # is there a word that goes on into this byte?
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    at = np.flatnonzero(inside)
    first = np.searchsorted(at, starts)
    place = at - np.repeat(starts, np.diff(np.append(first, len(at))))
    values = _BYTES.ravel()[((place & 63) << 8) | data[at]]
    if (long := np.flatnonzero(place >= 64)).size:
        values[long] *= _LONG ** (place[long] >> 6).astype(np.uint64)
    hashes = mix(np.add.reduceat(values, first) + (np.diff(np.append(first, len(at)))).astype(np.uint64) * _STEP)
    return hashes, np.searchsorted(starts, offsets)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of size words that begin at each word (fewer by size - 1 than the words)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):  # Horner's rule over all windows at once
        total *= _LONG
        total += words[k : k + n]
    return mix(total)


def sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of the size numbers that begin at each place (fewer by size - 1 than the numbers)."""
    width = 1
    while 2 * width <= size:
        x, width = np.minimum(x[: len(x) - width], x[width:]), 2 * width
    return np.minimum(x[: len(x) - (size - width)], x[size - width :]) if size > width else x
