"""Token counts of byte-level BPE by rank-synchronous merging of arrays.

Texts are cut into pre-tokens by the tokenizer's pattern. A batch of distinct pre-tokens is held as
one ragged array of symbols. In each step every sequence finds the pair of neighbours that has the lowest
rank in the merge list and merges all its places from the left, all sequences at once; sequences
without a mergeable pair are done. What is left are the tokens, which are counted. Lowest rank first
in each sequence is what the tokenizer does, so counts equal the library's. A task remembers the
counts of pre-tokens it has met.

The vocabulary is read from a ``tokenizer.json`` file of the byte-level kind (path given); its
size bounds what is sent to the tasks.

Defined results. A null text counts as empty and has no tokens. Special strings inside a text are one token each, as in
the library's default; nothing is added at the ends. Repeated rows get equal counts. Only doc_id and
text are read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sizes import handed_out

LIMIT = 512
CACHE_WORDS = 500_000
TEXTS_AT_ONCE = 256
# Fixed by the byte-level format: the cut into pre-tokens, and the bytes that stand for themselves.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


@dataclass
class Merges:
    symbol: np.ndarray  # by byte
    pairs: np.ndarray  # sorted keys left << 32 | right
    rank: np.ndarray
    result: np.ndarray
    special: list[str]


def load(path: str) -> Merges:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec["pre_tokenizer"]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if spec["normalizer"] or model["type"] != "BPE" or any(before.get(k) != v for k, v in plain.items()):
        raise ValueError("not a plain byte-level BPE file")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("special strings that take their surroundings are not supported")
    vocab = model["vocab"]
    letters, shifted = {}, 256
    for b in range(256):
        letters[b] = chr(b) if b in SHOWN else chr(shifted)
        shifted += b not in SHOWN
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    key = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
    result = np.array([vocab[a + b] for a, b in merges], np.int64)
    order = np.argsort(key, kind="stable")
    return Merges(np.array([vocab[letters[b]] for b in range(256)], np.int64), key[order],
                  np.arange(len(merges))[order], result[order], [t["content"] for t in spec["added_tokens"]])


def merged_lengths(m: Merges, words: list[bytes]) -> np.ndarray:
    """How many symbols of each word are left when nothing can be merged."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    symbol = m.symbol[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), length)
    out = length.copy()
    never = len(m.pairs)
    while len(symbol):
        key = symbol[:-1] << 32 | symbol[1:]
        at = np.minimum(np.searchsorted(m.pairs, key), never - 1)
        rank = np.full(len(symbol), never)
        fits = (word[:-1] == word[1:]) & (m.pairs[at] == key)
        rank[:-1][fits] = m.rank[at[fits]]
        first = np.flatnonzero(np.diff(word, prepend=-1))
        size = np.diff(np.append(first, len(word)))
        lowest = np.minimum.reduceat(rank, first)
        live = np.repeat(lowest < never, size)
        hit = live & (rank == np.repeat(lowest, size))
        # In a run of places (a pair of equal symbols overlaps itself) every second one merges.
        place = np.flatnonzero(hit)
        if len(place):
            start = np.flatnonzero(np.diff(place, prepend=-2) != 1)
            run = np.repeat(start, np.diff(np.append(start, len(place))))
            place = place[(np.arange(len(place)) - run) % 2 == 0]
            symbol[place] = m.result[at[place]]
            gone = np.zeros(len(symbol), bool)
            gone[place + 1] = True
            np.subtract.at(out, word[place], 1)
            live &= ~gone
        symbol, word = symbol[live], word[live]
    return out


class Counts:
    """Counts tokens of texts; remembers at most CACHE_WORDS pre-tokens."""

    def __init__(self, m: Merges):
        import regex

        self.m, self.known, self.cut = m, {}, regex.compile(PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, sorted(m.special, key=len, reverse=True)))) if m.special else None

    def _cut(self, text: str | None) -> tuple[list[str], int]:
        if not text:
            return [], 0
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return [w for p in parts for w in self.cut(p)], len(parts) - 1
        return self.cut(text), 0

    def count(self, texts: list[str | None]) -> list[int]:
        cut = [self._cut(t) for t in texts]
        new = set().union(*(w for w, _ in cut)).difference(self.known)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known, new = {}, set().union(*(w for w, _ in cut))
        new = list(new)
        if new:
            self.known.update(zip(new, merged_lengths(self.m, [w.encode() for w in new]).tolist()))
        return [sum(map(self.known.__getitem__, w)) + n for w, n in cut]


def token_counts(docs: DataFrame, m: Merges, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit."""
    sent = handed_out(docs.sparkSession, m)

    def run(batches):
        counts = Counts(sent())
        for batch in batches:
            n = []
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                n += counts.count(batch.column("text").slice(at, TEXTS_AT_ONCE).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
