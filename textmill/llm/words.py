"""Words of a batch of texts as numpy arrays, for work inside tasks.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return; in UTF-8 these bytes are never part of another character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


@dataclass
class Slice:
    """``data`` holds the texts one after the other, text i is data[offsets[i]:offsets[i + 1]];
    ``first`` is the place of text 0 in the batch."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a column of strings into slices of about ``limit`` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    n = len(texts)
    if not n:
        return
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        to = min(to, n)
        yield Slice(at, data[ends[at] : ends[to]], ends[at : to + 1] - ends[at])
        at = to


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Words:
    """Words in order: begin and end in the slice's data; text i has words first[i]:first[i + 1]."""

    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray


def words(s: Slice) -> Words:
    space = _SPACE[s.data]
    before = np.empty(len(space), bool)  # a byte after which a word may begin comes before
    before[:1] = True
    before[1:] = space[:-1]
    starts = s.offsets[:-1]
    before[starts[starts < len(space)]] = True
    begin = np.flatnonzero(~space & before)
    after = np.empty(len(space), bool)
    after[-1:] = True
    after[:-1] = space[1:]
    ends = s.offsets[1:]
    after[ends[ends > 0] - 1] = True
    end = np.flatnonzero(~space & after) + 1
    return Words(begin, end, np.searchsorted(begin, s.offsets))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    p = np.full(max(1, n), base, np.uint64)
    p[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(p, dtype=np.uint64)


_BYTE = mixed(np.arange(256, dtype=np.uint64)) | np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BASE = 0x5851F42D4C957F2D


def word_hashes(s: Slice, w: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit polynomial hash of every word; ``lower`` takes A-Z as a-z."""
    if not len(w.begin):
        return np.zeros(0, np.uint64)
    table = _BYTE[_LOWER] if lower else _BYTE
    length = w.end - w.begin
    place = np.arange(int(length.sum()))
    at = np.cumsum(length) - length
    inside = place - np.repeat(at, length)
    bytes_of = s.data[np.repeat(w.begin, length) + inside]
    with np.errstate(over="ignore"):
        return mixed(np.add.reduceat(table[bytes_of] * powers(_BASE, int(length.max()))[inside], at))


def grams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words within one text, and the text each belongs to."""
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = text[:m] == text[n - 1 :]
    total = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            total = total * np.uint64(_BASE) + hashes[i : i + m]
    return mixed(total[whole]), text[:m][whole]
