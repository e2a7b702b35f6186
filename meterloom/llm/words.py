"""Words of a column of texts as 64-bit hashes, computed for whole Arrow columns at once.

A word is a maximal run of bytes other than space and \\x09-\\x0D.  Hashes are multilinear over the bytes of a word, with
fixed pseudorandom coefficients, so equal words have equal hashes on every machine and in every run; unequal words
collide with a probability of about 2^-63 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
# Bytes of text worked on at a time: some 20 bytes of memory for each.
BLOCK = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer with full avalanche, so that the order of hashes is a pseudorandom order."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def coefficients(n: int, salt: int) -> np.ndarray:
    """``n`` fixed odd numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(salt << 40)) | np.uint64(1)


_BYTE = coefficients(256, 1)
_BYTE[WHITE] = 0
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_place = coefficients(256, 2)


class Words(NamedTuple):
    hashes: np.ndarray  # of all words, text after text
    first: np.ndarray  # first[i]:first[i + 1] are the words of text i
    start: np.ndarray  # byte positions in data
    stop: np.ndarray
    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # offsets[i]:offsets[i + 1] are the bytes of text i


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if texts.null_count:
        texts = texts.fill_null("")
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Words of each text; null texts have none.  ``lower`` folds A-Z."""
    global _place
    if not len(texts):
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), np.zeros(1, np.int64), none, none, none.astype(np.uint8), np.zeros(1, np.int64))
    data, offsets = _buffers(texts)
    inside = np.zeros(len(data) + 1, bool)
    np.logical_not(WHITE[data], out=inside[:-1])
    edge = inside[:-1].copy()
    edge[1:] &= ~inside[:-2]
    cut = offsets[1:-1]
    cut = cut[cut < len(data)]
    edge[cut] = inside[cut]
    start = np.flatnonzero(edge)
    last = inside[:-1] & ~inside[1:]
    cut = cut[cut > 0] - 1
    last[cut] = inside[cut]
    stop = np.flatnonzero(last) + 1
    hashes = np.zeros(len(start), np.uint64)
    table = _LOWER if lower else _BYTE
    if len(start):
        longest = int((stop - start).max())
        if longest > len(_place):
            _place = coefficients(longest + longest // 4, 2)
        marks = np.append(np.unique(np.searchsorted(start, np.arange(0, len(data), BLOCK))), len(start))
        for a, b in zip(marks[:-1], marks[1:], strict=True):
            low, high = start[a], stop[b - 1]
            at = start[a:b] - low
            span = np.diff(np.append(at, high - low))
            place = np.arange(high - low) - np.repeat(at, span)
            np.minimum(place, len(_place) - 1, out=place)  # white space behind a word, which counts as 0
            hashes[a:b] = np.add.reduceat(table[data[low:high]] * _place[place], at)
    return Words(mix(hashes), np.searchsorted(start, offsets), start, stop, data, offsets)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for j, c in enumerate(coefficients(n, 3 + n)):
        out += hashes[j : j + len(out)] * c
    return mix(out)


def blocks(batch: pa.RecordBatch, text: str = "text", size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    _, offsets = _buffers(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a Spark long."""
    return x.view(np.int64)
