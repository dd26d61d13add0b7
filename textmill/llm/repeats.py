"""Suffix-array dedup of repeated byte strings by prefix-free parsing.

A rolling hash over a few bytes triggers phrase ends, so equal text is cut alike wherever it stands. A
position belongs to the phrase that ends at the next trigger; what a trigger opens is the context of the phrase.
The parse is a table of phrase occurrences, each with a hash of its context (the order in the parse)
and of the phrase with everything its positions need (the entry of the dictionary). Three facts
settle nearly all of the corpus on this narrow table:

* a phrase whose context occurs once holds no repeated position;
* a dictionary entry that occurs twice holds only repeated positions;
* a context with a single entry needs nothing more.

Only for contexts with different entries the entries' texts are read, once each. The suffixes of the
phrases, with their context, are sorted as byte strings; neighbours that agree in all ``length`` bytes
are repeated positions. So the suffix array of the dictionary is only built where the parse leaves
a choice, which for repetitive text is a small part of it.

A context with very many entries (copies that differ a little around the same trigger) is not sorted in one place. Its
entries stay in blocks; a block names each of its strings once, by 128 bits of hash, the names of all blocks meet by
hash part, and each block hears which of its names another string has, too. So a string that every copy has
travels once a block.

A position with no trigger near belongs to the first smallest hash in its reach. Which of the two applies, and where,
depends on the bytes of the position's own string alone, so equal strings meet.

Every byte covered by a repeated string of ``length`` bytes goes. Strings do not cross documents and are judged on the
input. Defined results: a null text is empty; texts shorter than ``length`` are kept whole;
repeated rows are occurrences of their own. Only doc_id and text are read. A task holds one text (or
about a megabyte of them) at a time, at some 100 bytes per byte of it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import Rewritten, stage
from .sizes import sent_if_small
from .words import _BYTE, Slice, mixed, powers, slices

LENGTH = 200
CONTEXT = 64  # bytes from the trigger on that choose where a phrase is looked at
TRIGGER_BYTES = 8
EVERY = 64  # one position in so many triggers
FAR_AT_ONCE = 4_096
BROADCAST_WIDTH = 32  # bytes of a context in a broadcast
SORT_GROUP = 2_048  # entries of one context sorted in one place
BLOCK_BITS = 10  # a block of a large context has so many bits of entries
PART_NAMES = 1 << 20  # names that meet in one place, on average
HOT_ROWS = 1_000  # phrases of an entry from which on the entry may be sent to all tasks
HOT_ENTRIES = 200_000  # entries sent at most

_BASE = 0x9E3779B97F4A7C15
_SECOND = 0xD1342543DE82EF95
_STEP = np.uint64(0x5851F42D4C957F2D)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows that repeat id and text share a key, and a result."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))


class Hashed:
    """Prefix sums that give the hash of any run of bytes of a slice."""

    def __init__(self, data: np.ndarray, base: int = _BASE):
        n = len(data)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * powers(base, n), dtype=np.uint64)))
        self.shift = powers(pow(base, -1, 1 << 64), n + 1)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[end] - self.sums[begin]) * self.shift[begin])


def _next_at_or_after(marks: np.ndarray, n: int) -> np.ndarray:
    """For each position the first mark from it on (n if none)."""
    at = np.searchsorted(marks, np.arange(n))
    return np.append(marks, n)[at]


def phrases(s: Slice, length: int = LENGTH, context: int = CONTEXT) -> dict[str, np.ndarray]:
    """Phrase occurrences of a slice: text, q (context hash), e (entry hash), low and high (first and
    last position in the text), trigger."""
    n = len(s.data)
    sizes = np.diff(s.offsets)
    end = np.repeat(s.offsets[1:], sizes)
    rolling = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(TRIGGER_BYTES, n)):
            rolling[: n - k] = rolling[: n - k] * _STEP + _BYTE[s.data[k:]]
    rolling = mixed(rolling)
    position = np.arange(n)
    starts = position[position + length <= end]  # positions whose string lies in the text
    if not len(starts):
        return {k: np.zeros(0, np.int64) for k in ("text", "q", "e", "low", "high", "trigger")}
    reach = length - context
    whole = position + TRIGGER_BYTES <= end
    first = _next_at_or_after(np.flatnonzero(whole & (rolling % np.uint64(EVERY) == 0)), n)[starts]
    trigger = np.where(first - starts <= reach, first, -1)
    far = np.flatnonzero(trigger < 0)
    near = np.lib.stride_tricks.sliding_window_view(rolling, reach + 1)
    for i in range(0, len(far), FAR_AT_ONCE):
        part = far[i : i + FAR_AT_ONCE]
        trigger[part] = starts[part] + near[starts[part]].argmin(1)
    kind = np.zeros(len(starts), np.int8)
    kind[far] = 1
    text = np.searchsorted(s.offsets, starts, "right") - 1
    fresh = np.ones(len(starts), bool)  # a phrase is a run of positions with one trigger
    fresh[1:] = (trigger[1:] != trigger[:-1]) | (kind[1:] != kind[:-1]) | (np.diff(starts) != 1) | (np.diff(text) != 0)
    a = np.flatnonzero(fresh)
    b = np.append(a[1:], len(starts)) - 1
    low, high, trigger, text = starts[a], starts[b], trigger[a], text[a]
    hashed = Hashed(s.data)
    q = hashed(trigger, trigger + context)
    with np.errstate(over="ignore"):
        e = mixed(hashed(low, high + length) + ((trigger - low) * 4096 + (high - low)).astype(np.uint64))
    base = s.offsets[text]
    return {"text": text, "q": q.view(np.int64), "e": e.view(np.int64), "low": low - base, "high": high - base, "trigger": trigger - base}


def _parsed(length: int, context: int):
    def run(batches):
        for batch in batches:
            key = batch.column("key").to_numpy()
            for s in slices(batch.column("text")):
                p = phrases(s, length, context)
                yield pa.RecordBatch.from_pydict({
                    "q": p["q"], "e": p["e"], "key": key[s.first + p["text"]],
                    **{c: p[c].astype(np.int32) for c in ("low", "high", "trigger")}})

    return run


def _lists(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per key with an array of its rows. Its size follows the repeats, so texts meet it in a shuffle join at any size."""
    return stage(rows.groupBy("key").agg(F.collect_list(F.struct(*columns)).alias("found")), "lists")


def _entry_texts(length: int):
    def run(batches):
        for batch in batches:
            rows = {c: [] for c in ("q", "e", "back", "n", "entry")}
            for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
                raw = text.encode()
                for f in found:
                    rows["q"].append(f["q"])
                    rows["e"].append(f["e"])
                    rows["back"].append(f["trigger"] - f["low"])
                    rows["n"].append(f["high"] - f["low"] + 1)
                    rows["entry"].append(raw[f["low"] : f["high"] + length])
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], list(rows))

    return run


_NAME = np.dtype([("w", np.int64), ("v", np.int64)])


def _pairs(w: np.ndarray, v: np.ndarray) -> np.ndarray:
    out = np.empty(len(w), _NAME)
    out["w"], out["v"] = w, v
    return out


class Suffixes:
    """All positions of some entries: which entry (owner), which position (place), and a key of the position's
    string together with its context and its distance to the trigger."""

    def __init__(self, table: pa.Table, length: int):
        q, back, n = (table.column(c).to_numpy() for c in ("q", "back", "n"))
        entry = table.column("entry").to_pylist()
        lengths = np.fromiter(map(len, entry), np.int64, len(entry))
        self.data = np.frombuffer(b"".join(entry), np.uint8)
        self.length = length
        self.owner = np.repeat(np.arange(len(entry)), n)
        self.place = np.arange(len(self.owner)) - np.repeat(np.cumsum(n) - n, n)
        self.begin = (np.cumsum(lengths) - lengths)[self.owner] + self.place
        self.q, self.distance = q[self.owner], (back[self.owner] - self.place).astype(np.int64)
        self.key = self._hash(_BASE)

    def _hash(self, base: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            led = mixed(self.q.view(np.uint64)) + self.distance.astype(np.uint64)
            return mixed(Hashed(self.data, base)(self.begin, self.begin + self.length) ^ mixed(led))

    def names(self) -> np.ndarray:
        """128 bits for each position's string."""
        return _pairs(self.key.view(np.int64), self._hash(_SECOND).view(np.int64))

    def equal_to_a_neighbour(self) -> np.ndarray:
        """Places in these arrays whose string stands beside an equal one in suffix order.

        Only strings whose key is not alone are put in order; that the strings are equal is seen from their bytes.
        """
        _, at, count = np.unique(self.key, return_inverse=True, return_counts=True)
        some = np.flatnonzero(count[at] > 1)
        rows = np.empty((len(some), 16 + self.length), np.uint8)
        rows[:, :8] = self.q[some].view(np.uint8).reshape(-1, 8)
        rows[:, 8:16] = self.distance[some].view(np.uint8).reshape(-1, 8)
        if len(some):
            rows[:, 16:] = np.lib.stride_tricks.sliding_window_view(self.data, self.length)[self.begin[some]]
        order = np.argsort(rows.view(f"V{rows.shape[1]}").ravel(), kind="stable")
        same = (rows[order[1:]] == rows[order[:-1]]).all(1)
        return some[np.union1d(order[1:][same], order[:-1][same])]


def _by_entry(table: pa.Table, suffixes: Suffixes, some: np.ndarray) -> pa.Table:
    """(q, e, at): the positions ``some`` (in order) of the entries that have any."""
    entry, first = np.unique(suffixes.owner[some], return_index=True)
    at = pa.ListArray.from_arrays(pa.array(np.append(first, len(some)), pa.int32()), pa.array(suffixes.place[some], pa.int32()))
    q, e = (pa.array(table.column(c).to_numpy()[entry]) for c in ("q", "e"))
    return pa.Table.from_arrays([q, e, at], ["q", "e", "at"])


def _neighbours(length: int):
    """Sort the suffixes of the entries of each context; give by entry (q, e) the positions equal to a neighbour."""

    def sorted_part(held):
        table = pa.Table.from_batches(held)
        suffixes = Suffixes(table, length)
        return _by_entry(table, suffixes, suffixes.equal_to_a_neighbour()).to_batches()

    def run(batches):
        held, last, size = [], None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            q = batch.column("q").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(q)) + 1), len(q)]
            for a, b in zip(cuts, cuts[1:]):
                if held and q[a] != last and size > SORT_GROUP:
                    yield from sorted_part(held)
                    held, size = [], 0
                last = q[a]
                held.append(batch.slice(a, b - a))
                size += b - a
        if held:
            yield from sorted_part(held)

    return run


def _named(length: int, parts: int):
    """Names of the strings of each block: (part, block, w, v, twice), one row per block and hash part; a name
    stands once in a row, ``twice`` says whether several positions of these entries have it."""

    def run(batches):
        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(block)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                names, count = np.unique(Suffixes(pa.Table.from_batches([batch.slice(a, b - a)]), length).names(), return_counts=True)
                part = (np.ascontiguousarray(names["v"]).view(np.uint64) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                names, twice, part = names[order], count[order] > 1, part[order]
                first = np.flatnonzero(np.diff(part, prepend=-1))
                at = np.append(first, len(part)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[first], pa.int64()), pa.array(np.full(len(first), block[a]), pa.int64()),
                     *(pa.ListArray.from_arrays(at, pa.array(np.ascontiguousarray(x))) for x in (names["w"], names["v"], twice))],
                    ["part", "block", "w", "v", "twice"])

    return run


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _shared_names(table: pa.Table) -> pa.Table:
    """Of the names of one part: those that a block's strings share with another string, by block."""
    sizes = table.column("w").combine_chunks().value_lengths().to_numpy()
    block = np.repeat(table.column("block").to_numpy(), sizes)
    names, at, count = np.unique(_pairs(_flat(table, "w"), _flat(table, "v")), return_inverse=True, return_counts=True)
    many = count > 1
    many[at[_flat(table, "twice")]] = True
    some = np.flatnonzero(many[at])
    some = some[np.argsort(block[some], kind="stable")]
    first = np.flatnonzero(np.diff(block[some], prepend=block[some[0]] - 1)) if len(some) else some
    cuts = np.append(first, len(some)).astype(np.int32)
    w, v = (pa.ListArray.from_arrays(cuts, pa.array(np.ascontiguousarray(names[at[some]][c]))) for c in ("w", "v"))
    return pa.Table.from_arrays([pa.array(block[some[first]], pa.int64()), w, v], ["block", "w", "v"])


def _places(length: int):
    """Positions, by entry, of a block's strings whose names are shared."""

    def run(entries: pa.Table, shared: pa.Table) -> pa.Table:
        suffixes = Suffixes(entries, length)
        some = np.flatnonzero(np.isin(suffixes.names(), _pairs(_flat(shared, "w"), _flat(shared, "v")))) if shared.num_rows else []
        return _by_entry(entries, suffixes, np.asarray(some, np.int64))

    return run


def _told_by_names(large: DataFrame, length: int) -> DataFrame:
    """(q, e, at) for the entries of contexts with very many of them; ``large`` is written and has block."""
    parts = -(-int(large.agg(F.sum("n")).first()[0] or 1) // PART_NAMES)
    names = large.mapInArrow(_named(length, parts), "part long, block long, w array<long>, v array<long>, twice array<boolean>")
    shared = names.groupBy("part").applyInArrow(_shared_names, "block long, w array<long>, v array<long>")
    return large.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_places(length), "q long, e long, at array<int>")


def repeated_runs(docs: DataFrame, length: int = LENGTH, context: int = CONTEXT) -> DataFrame:
    """Repeated positions: key, low, high and at; all from low to high, or those of ``at`` (counted from low).

    ``docs`` has key and text; keys may repeat.
    """
    table = Rewritten(docs.select("key", "text").mapInArrow(
        _parsed(length, context), "q long, e long, key long, low int, high int, trigger int"), "parse")
    parse = table.df
    twice = stage(parse.groupBy("q").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("q"), "twice")
    parse = table.replace(parse.join(sent_if_small(twice, F.lit(BROADCAST_WIDTH)), "q"))
    entries = parse.groupBy("q", "e").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "low", "high", "trigger")).alias("one"))
    entries = stage(entries, "dictionary")
    several = entries.groupBy("q").agg(F.count(F.lit(1)).alias("entries")).where("entries > 1")
    open_ones = stage(entries.join(several, "q").select("q", "e", "entries", "one.*"), "open_entries")
    listed = _lists(open_ones, "q", "e", "low", "high", "trigger")
    cut = docs.select("key", "text").join(listed, "key").select("text", "found").mapInArrow(
        _entry_texts(length), "q long, e long, back int, n int, entry binary")
    cut = stage(cut, "entry_texts")
    sizes = several.where(F.col("entries") > SORT_GROUP).select(F.col("q").alias("_q"))
    small = cut.join(sizes, F.col("q") == F.col("_q"), "left_anti").repartition("q").sortWithinPartitions("q", "e")
    found = small.mapInArrow(_neighbours(length), "q long, e long, at array<int>")
    large = cut.join(sizes, F.col("q") == F.col("_q"), "left_semi")
    large = stage(large.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)), "large_contexts")
    # Rows that repeat bring an entry twice; it is a whole one then, and what is found for it makes no difference.
    partly = found.unionByName(_told_by_names(large, length))
    # All phrases of an entry that occurs twice are repeated. Entries with very many phrases are few, whatever the input,
    # so their phrases stay where they are.
    least = max(HOT_ROWS, parse.count() // HOT_ENTRIES)
    hot = F.broadcast(entries.where(F.col("n") > least).select("q", "e"))  # fewer than HOT_ENTRIES
    known = entries.where(F.col("n") <= least).select("q", "e", (F.col("n") > 1).alias("whole"))
    marked = parse.join(hot, ["q", "e"], "left_anti").join(known, ["q", "e"]).join(partly, ["q", "e"], "left").where("whole OR at IS NOT NULL")
    marked = marked.select("key", "low", "high", F.when(~F.col("whole"), F.col("at")).alias("at"))
    of_hot = parse.join(hot, ["q", "e"], "left_semi").select("key", "low", "high", F.lit(None).cast("array<int>").alias("at"))
    return stage(marked.unionByName(of_hot), "marked")


def _cut_out(length: int):
    def run(batches):
        for batch in batches:
            out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
                raw = text.encode()
                gone = np.zeros(len(raw) + 1, np.int64)  # +1 where a removed string begins, -1 behind its end
                for f in found or ():
                    if f["at"] is None:
                        gone[f["low"]] += 1
                        gone[f["high"] + length] -= 1
                    else:
                        at = f["low"] + np.array(f["at"])
                        np.add.at(gone, at, 1)
                        np.add.at(gone, at + length, -1)
                cover = np.cumsum(gone)[:-1] > 0 if found else np.zeros(len(raw), bool)
                kept = np.frombuffer(raw, np.uint8)[~cover].tobytes() if found else raw
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(int(cover.sum()))
                out["n_spans"].append(int((np.diff(cover.astype(np.int8), prepend=0) == 1).sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, k) for v, k in zip(out.values(), kinds))], ["doc_id", *out])

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH, context: int = CONTEXT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left)."""
    keyed = _keyed(docs)
    marked = _lists(repeated_runs(keyed, length, context), "low", "high", "at")
    return keyed.join(marked, "key", "left").select("doc_id", "text", "found").mapInArrow(
        _cut_out(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
