"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of consecutive words in which words ``period`` apart are equal, with no smaller
period, and which no neighbouring word extends. Every stretch of a power-of-two length is given a
name: level 0 names the words, level k + 1 names pairs of level-k names ``2**k`` apart, so equal names mean
equal words. At each level a stretch and its next occurrence within twice its length propose their distance as a
period; proposals at neighbouring places with the same distance form one arithmetic progression, of which the
first is kept. Proposals are extended to both sides with the names, longest first, and repeated finds go.

A run of period q that is at least three periods long is found at the level whose length is in [q, 2q): there a stretch
of the run occurs next exactly q further, as it holds a whole primitive period. So every run that is asked for is proposed.

Only stretches that occur at least twice go on to the next level. A task works on about a megabyte of text at once, many documents
together; a longer text is a slice of its own, and needs some 60 bytes of memory per word.

Defined results. A null or empty text, or one of white space, has no words and no runs. Words are runs of bytes other than white
space (space, tab to carriage return) and compared byte by byte. Rows that repeat an id are rows of their own, an empty
table gives none. Only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..workspace import spread
from .words import Slice, slices, words

LEAST_WORDS = 6
LEAST_EXPONENT = 4
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _named(keys: np.ndarray, place: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key occurs again, sorted, with the key's name; heads of the progressions of
    successors within twice ``span``, with their distance."""
    order = np.argsort(keys, kind="stable")
    at, sorted_keys = place[order], keys[order]
    same = sorted_keys[1:] == sorted_keys[:-1]
    again = np.zeros(len(at), bool)
    again[1:] |= same
    again[:-1] |= same
    name = np.cumsum(np.concatenate([[0], ~same]))[again]
    gap = np.diff(at)
    near = same & (gap <= 2 * span)
    begin, distance = at[:-1][near], gap[near]
    back = np.argsort(begin, kind="stable")
    begin, distance = begin[back], distance[back]
    head = np.ones(len(begin), bool)
    head[1:] = (np.diff(begin) != 1) | (np.diff(distance) != 0)
    at = at[again]
    back = np.argsort(at, kind="stable")
    return at[back], name[back].astype(np.int64), begin[head], distance[head]


def _name_at(level: tuple[np.ndarray, np.ndarray], at: np.ndarray) -> np.ndarray:
    """-1 where the stretch occurs once or would leave the words."""
    place, name = level
    i = np.minimum(np.searchsorted(place, at), len(place) - 1)
    return np.where(place[i] == at, name[i], -1)


def _extended(levels: list, a: np.ndarray, b: np.ndarray, ahead: bool) -> np.ndarray:
    """How many words agree from ``a`` and ``b`` on, or before them."""
    total = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step = total if ahead else -total - (1 << k)
        left = _name_at(levels[k], a + step)
        total += ((left >= 0) & (left == _name_at(levels[k], b + step))).astype(np.int64) << k
    return total


def find_runs(codes: np.ndarray, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in ``codes``, by start, then period.

    Texts may follow each other if no two share a code: a stretch over their border then occurs once.
    """
    if least_exponent < 3:
        raise ValueError("runs of fewer than three periods are not all proposed")
    n = len(codes)
    levels, starts, periods = [], [], []
    keys, place, span = codes.astype(np.int64), np.arange(n), 1
    while len(place):
        place, name, begin, distance = _named(keys, place, span)
        if not len(place):
            break
        levels.append((place, name))
        starts.append(begin)
        periods.append(distance)
        names = np.full(n + span, -1, np.int64)
        names[place] = name
        after = names[place + span]
        place, keys = place[after >= 0], (name * (len(name) + 1) + after)[after >= 0]
        span *= 2
    if not levels:
        return (np.zeros(0, np.int64),) * 3
    a, q = np.concatenate(starts), np.concatenate(periods)
    back = _extended(levels, a, a + q, False)
    length = back + q + _extended(levels, a, a + q, True)
    fits = length >= np.maximum(least_words, least_exponent * q)
    _, first = np.unique((a - back)[fits] * (n + 1) + q[fits], return_index=True)
    return (a - back)[fits][first], length[fits][first], q[fits][first]


class _Words:
    """The words of a slice one after the other, without what is between them."""

    def __init__(self, s: Slice):
        w = words(s)
        self.length = w.end - w.begin
        self.first = w.first
        inside = np.zeros(len(s.data) + 1, np.int8)
        inside[w.begin] += 1
        np.subtract.at(inside, w.end, 1)
        self.data = s.data[np.cumsum(inside[:-1]).astype(bool)]
        self.text = np.repeat(np.arange(len(s)), np.diff(self.first))

    def codes(self) -> np.ndarray:
        """Equal for equal words of one text, unlike for words of two texts."""
        offsets = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        column = pa.Array.from_buffers(pa.large_binary(), len(self.length), [None, pa.py_buffer(offsets), pa.py_buffer(self.data)])
        code = column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return code * len(self.first) + self.text

    def joined(self, keep: np.ndarray) -> pa.Array:
        """The kept words of each text with one space between them."""
        length, text = self.length[keep], self.text[keep]
        later = np.zeros(len(text), np.int64)
        later[1:] = text[1:] == text[:-1]  # words with a space before them
        data = np.full(int(length.sum() + later.sum()), 0x20, np.uint8)
        kept = self.data[np.repeat(keep, self.length)]
        data[np.arange(len(kept)) + np.repeat(np.cumsum(later), length)] = kept
        size = np.bincount(text, length + later, len(self.first) - 1).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def periodic_runs(docs: DataFrame, *, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start and length in words, period; by start, then period) and collapsed:
    the words, one space between them, without those that a run holds after its first period."""

    def of_slice(s: Slice) -> list[pa.Array]:
        w = _Words(s)
        start, length, period = find_runs(w.codes(), least_words, least_exponent)
        change = np.zeros(len(w.length) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.subtract.at(change, start + length, 1)
        text = w.text[start]
        runs = pa.StructArray.from_arrays([pa.array(x) for x in (start - w.first[text], length, period)], ["start", "length", "period"])
        offsets = np.searchsorted(text, np.arange(len(s) + 1)).astype(np.int32)
        return [pa.array(np.diff(w.first).astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), runs),
                w.joined(np.cumsum(change[:-1]) == 0).cast(pa.string())]

    def run(batches):
        for batch in batches:
            for s in slices(batch.column("text")):
                ids = batch.column("doc_id").slice(s.first, len(s))
                yield pa.RecordBatch.from_arrays([ids, *of_slice(s)], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return spread(rows).mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length/period, compared as fractions; of equals the one that comes first."""
    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run.length * best.period > best.length * run.period), run).otherwise(best)

    return F.reduce(runs, F.lit(None).cast(RUN), better)


def with_planted_run(docs: DataFrame) -> DataFrame:
    """doc_id and text; of one document in ten, told by its id, all words from some place on repeat with a short period.

    A document without id or words stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1).cast("long") + F.floor((n - a) / (g % 8 + 3))

        def of(b: Column) -> Column:
            at = lambda i: F.when(i < b.a, i).otherwise(b.a + (i - b.a) % b.p).cast("int")
            return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, at(i))), " ")

        return F.when(n > 0, let(F.struct(a.alias("a"), p.alias("p")), of))

    cut = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    planted = F.when(h % 10 == 0, let(cut, repeated))
    return docs.select("doc_id", F.coalesce(planted, F.col("text")).alias("text"))
