"""Words of many texts at once, as numpy arrays over one Arrow batch.

A text is never turned into Python strings: the UTF-8 bytes of a batch stay one array, words are
start and end positions in it, and a word is known by a 64-bit hash of its bytes. Two different
words share a hash with a chance of about 5e-20; no result below guards against that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Everything but blank, tab, line feed, vertical tab, form feed and carriage return.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Digits, a-z and every byte of a character beyond ASCII (for texts in lower case).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_M1, _M2, _SEED = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several hashes in order."""
    out = np.full(len(parts[0]), _SEED, dtype=np.uint64)
    for p in parts:
        out = mix(out * _M2 + p + _SEED)
    return out


@dataclass
class Slice:
    """Some texts of a batch: rows first..last, their bytes, and where each begins in them."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.last - self.first


@dataclass
class Words:
    """Words of a slice; ``bounds[i]:bounds[i + 1]`` are those of text i."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray


def slices(column: pa.Array | pa.ChunkedArray, lower: bool = False, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a column in slices of about ``size`` bytes. A null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1, first + 1)
        own = data[offsets[first]:offsets[last]]
        yield Slice(first, last, _LOWER[own] if lower else own, offsets[first:last + 1] - offsets[first])
        first = last


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, eight bytes at a time."""
    length = end - start
    out = mix(length.astype(np.uint64) + _SEED)
    if not len(start):
        return out
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded.view(np.uint8)[:8].view("<u8"), (len(data) + 1,), (1,))
    out = mix(out ^ (eights[start] & _KEEP[np.minimum(length, 8)]) * _M2)
    left = np.flatnonzero(length > 8)
    done = 8
    while len(left):
        lane = eights[start[left] + done] & _KEEP[np.minimum(length[left] - done, 8)]
        out[left] = mix(out[left] * _M1 + lane + _SEED)
        done += 8
        left = left[length[left] > done]
    return out


def words(texts: Slice, kind: np.ndarray, hashed: bool = True) -> Words:
    """All words of a slice, in order; ``kind`` tells the bytes that words consist of."""
    inside = kind[texts.data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = texts.offsets[1:-1]
    edges = edges[edges < len(inside)]
    opens[edges] = inside[edges]
    start = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = edges[edges > 0] - 1
    closes[edges] = inside[edges]
    end = np.flatnonzero(closes) + 1
    return Words(start, end, hashes(texts.data, start, end) if hashed else np.empty(0, np.uint64),
                 np.searchsorted(start, texts.offsets))


def owners(bounds: np.ndarray) -> np.ndarray:
    """For each item, the row it belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values by row, where rows are ranges of positions."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def counts(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of marked positions by row, for masks with few marks."""
    return np.diff(np.searchsorted(np.flatnonzero(mask), bounds))


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every run of ``size`` words within one text."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    last = np.repeat(w.bounds[1:], np.diff(w.bounds))[:n]
    at = np.flatnonzero(np.arange(n) + size <= last)
    return at, chain([w.hash[at + k] for k in range(size)])
