"""Line dedup by pairwise alignment: blocks of lines that an earlier document has are deleted.

Lines (cut at line feeds) are hashed, and so are the shortest runs of lines with MIN_BLOCK_BYTES that begin or end at
each line: every line of a common block is in such a run of the block. A run that several documents hold links each of
them to the first holder: a star, so a run in any number of documents makes as many links, not their square. Each linked pair is
aligned with patience diff: equal heads and tails, then lines that are unique in both in their longest common order, then
the same between them. Runs of aligned lines with at least MIN_BLOCK_BYTES bytes are common blocks and are deleted
from the later document (the larger id).

Deletions are judged on the input. Defined results: a null text is empty, and an empty text has no lines.
Documents with a null id come last. Rows that repeat id and text are one document and get equal results. Only
doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import stage
from .sizes import sent_if_small
from .words import mixed

MIN_BLOCK_BYTES = 100
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _unique_common(a: list, b: list, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Places of lines that occur once in a[a0:a1] and once in b[b0:b1], by their place in ``a``."""
    places: dict = {}
    for side, lines, lo, hi in ((0, a, a0, a1), (1, b, b0, b1)):
        for i in range(lo, hi):
            at = places.setdefault(lines[i], [-1, -1])
            at[side] = i if at[side] == -1 else -2
    return sorted((i, j) for i, j in places.values() if i >= 0 and j >= 0)


def _longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence in which the second places rise, by patience sorting."""
    from bisect import bisect_left

    tops, piles, before = [], [], []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        tops[p : p + 1] = [j]
        piles[p : p + 1] = [k]
        before.append(piles[p - 1] if p else -1)
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def aligned(a: list, b: list) -> list[tuple[int, int]]:
    """Places (i, j) of lines of ``a`` and ``b`` that patience diff puts side by side, in order."""
    out, waiting = [], [(0, len(a), 0, len(b))]
    while waiting:
        a0, a1, b0, b1 = waiting.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        at = (a0, b0)
        for i, j in [*_longest_rising(_unique_common(a, b, a0, a1, b0, b1)), (a1, b1)]:
            if at != (a0, b0) or (i, j) != (a1, b1):  # something unique was found
                waiting.append((at[0], i, at[1], j))
            if (i, j) != (a1, b1):
                out.append((i, j))
                at = (i + 1, j + 1)
    return sorted(out)


def common_blocks(a: list, b: list, sizes: list[int], least: int = MIN_BLOCK_BYTES) -> list[tuple[int, int]]:
    """Runs [begin, end) of lines of ``b`` that are aligned one after the other with ``a``."""
    runs: list[list[int]] = []
    last = None
    for i, j in aligned(a, b):
        if last == (i - 1, j - 1):
            runs[-1][1] = j + 1
        else:
            runs.append([j, j + 1])
        last = (i, j)
    return [(x, y) for x, y in runs if sum(sizes[x:y]) >= least]


def _blocks_of_pairs(least: int):
    def run(batches):
        for batch in batches:
            key, begin, end = [], [], []
            columns = (batch.column(c) for c in ("key", "earlier", "later", "sizes"))
            for k, a, b, n in zip(*(c.to_pylist() for c in columns)):
                for x, y in common_blocks(a, b, n, least):
                    key.append(k)
                    begin.append(x)
                    end.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(begin, pa.int32()), pa.array(end, pa.int32())], ["key", "begin", "end"])

    return run


def line_table(keyed: DataFrame) -> DataFrame:
    """key, doc_id, h (hashes of the lines) and n (their bytes)."""
    lines = F.when(F.col("text") == "", F.array().cast("array<string>")).otherwise(F.split("text", "\n", -1))
    return keyed.select("key", "doc_id", lines.alias("l")).select(
        "key", "doc_id", F.transform("l", lambda x: F.xxhash64(x)).alias("h"), F.transform("l", lambda x: F.octet_length(x)).alias("n"))


def run_keys(h: np.ndarray, n: np.ndarray, least: int) -> np.ndarray:
    """Distinct hashes of the shortest runs of lines with ``least`` bytes that begin or end at each line."""
    total = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
    lines = np.arange(len(h))
    end = np.searchsorted(total, total[:-1] + least)
    begin = np.searchsorted(total, total[1:] - least, "right") - 1
    begins, ends = end <= len(h), total[1:] >= least
    x = np.concatenate([lines[begins], begin[ends]])
    y = np.concatenate([end[begins], lines[ends] + 1])
    up, down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(h), f, np.uint64)])) for f in (_FACTOR, _INVERSE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h.astype(np.int64).view(np.uint64) * up[:-1])])
    return np.unique(mixed((sums[y] - sums[x]) * down[x] + (y - x).astype(np.uint64)).view(np.int64))


def _runs_of_lines(least: int):
    def run(batches):
        for batch in batches:
            keys = [run_keys(np.array(h, np.int64), np.array(n, np.int64), least)
                    for h, n in zip(batch.column("h").to_pylist(), batch.column("n").to_pylist())]
            at = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
            runs = pa.array(np.concatenate([np.zeros(0, np.int64), *keys]))
            yield pa.RecordBatch.from_arrays([batch.column("key").take(at), batch.column("doc_id").take(at), runs], ["key", "doc_id", "run"])

    return run


def linked_pairs(lines: DataFrame, least: int = MIN_BLOCK_BYTES) -> DataFrame:
    """(earlier, later): keys of documents that share a run of lines, the earlier one its first holder."""
    each = lines.select("key", "doc_id", "h", "n").mapInArrow(_runs_of_lines(least), "key long, doc_id long, run long")
    each = each.select("key", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key").alias("place"), "run")
    shared = each.groupBy("run").agg(F.count(F.lit(1)).alias("df"), F.min("place").alias("first")).where("df > 1")
    held = each.select("key", "run").join(shared.select("run", F.col("first.key").alias("earlier")), "run")
    return held.where("key != earlier").select("earlier", F.col("key").alias("later")).distinct()


def _without(batches):
    for batch in batches:
        out = {c: [] for c in ("n_lines", "n_removed", "kept_sha256", "kept")}
        for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
            lines = text.split("\n") if text else []
            kept = np.ones(len(lines), bool)
            for f in found or ():
                kept[f["begin"] : f["end"]] = False
            rest = "\n".join(x for x, k in zip(lines, kept) if k) if found else text
            out["n_lines"].append(len(lines))
            out["n_removed"].append(int((~kept).sum()))
            out["kept_sha256"].append(hashlib.sha256(rest.encode()).hexdigest())
            out["kept"].append(rest)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, k) for v, k in zip(out.values(), kinds))], ["doc_id", *out])


def without_common_blocks(docs: DataFrame, rare: int | None = None, least: int = MIN_BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, kept_sha256, kept (the text left).

    ``rare`` is accepted for older callers and has no effect: no line is too frequent to link.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    lines = stage(line_table(keyed), "lines")
    lines = lines.dropDuplicates(["key"])
    pairs = stage(linked_pairs(lines, least), "pairs")
    both = pairs.join(lines.select(F.col("key").alias("earlier"), F.col("h").alias("a")), "earlier")
    both = both.join(lines.select(F.col("key").alias("later"), "h", "n"), "later")
    both = both.select(F.col("later").alias("key"), F.col("a").alias("earlier"), F.col("h").alias("later"), F.col("n").alias("sizes"))
    blocks = both.mapInArrow(_blocks_of_pairs(least), "key long, begin int, end int").distinct()
    found = stage(blocks.groupBy("key").agg(F.collect_list(F.struct("begin", "end")).alias("found")), "blocks")
    rows = keyed.join(sent_if_small(found, F.size("found") * 24 + 64), "key", "left").select("doc_id", "text", "found")
    return rows.mapInArrow(_without, "doc_id long, n_lines long, n_removed long, kept_sha256 string, kept string")
