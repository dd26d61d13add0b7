"""Byte-level BPE encoding with a global shuffle of distinct words, and decoding.

Texts are cut into pre-tokens by the tokenizer's pattern. Documents are taken in blocks of a few megabytes. Within a block every
distinct pre-token gets a slot, and a document is the list of its pre-tokens' slots, its places. Only a block's distinct words
go on, packed by a hash of the word: all blocks' rows of a hash part meet in one task, where each distinct word is
encoded once, and its ids go back to the blocks that asked. There they are joined by slot, and documents are put
together in the order of their places.

The slots are written once, bucketed by block, so they are not shuffled: what crosses the network is a block's dictionary there
and its ids back, both packed. A word has at most one entry per block,
however frequent it is: no word makes a hot key. A block is a bounded group (a document larger than a block is one of its own).
A task remembers at most KNOWN_WORDS words; beyond that it starts anew, which costs time only. Blocks are put together and
ids are decoded AT_ONCE places at a time, and a block's texts come to Python in small batches: a worker holds
one block, and of that only its places and ids as plain numbers.

A word that is a token is that token. Any other is merged from its bytes, lowest rank first, leftmost first; long words with a heap.
Decoding joins the ids with the table of token bytes, whose size is the vocabulary's, inside the tasks.

Defined results. A null text counts as empty and has no ids. Nothing is special: strings that look like special tokens are ordinary
text. Rows that repeat an id are rows of their own, an empty table gives none. Only the id and the text are read.
Null ids and ids outside the table decode to nothing, null lists to null. A text needs some 60 bytes of memory per pre-token.
"""

from __future__ import annotations

import base64
import heapq
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workspace import fresh_path, small_batches, spread
from .sizes import input_bytes, unused

BLOCK_BYTES = 8 << 20
PART_BYTES = 4 << 20  # of input for each hash part of the words
MOST_PARTS = 50_000
KNOWN_WORDS = 250_000
AT_ONCE = 1 << 17  # slots or ids that are replaced at once
LONG_WORD = 64


def load(path: str) -> dict[bytes, int]:
    """Ranks by token, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every byte must be a token")
    return ranks


# --- one word ---------------------------------------------------------------------------------


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONG_WORD:
        return _merged_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        pairs = [ranks.get(a + b, -1) for a, b in zip(parts, parts[1:])]
        least = min((r for r in pairs if r >= 0), default=-1)
        if least < 0:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def _merged_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in time n log n: neighbours in linked lists, pairs in a heap by rank, then place."""
    n = len(word)
    end = list(range(1, n + 1))  # of the part that begins here; 0 once it is gone
    before = list(range(-1, n - 1))
    waiting = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(waiting, (rank, i, j, end[j]))

    for i in range(n):
        offer(i)
    while waiting:
        _, i, j, k = heapq.heappop(waiting)
        if end[i] != j or end[j] != k:  # one of the parts has changed since
            continue
        end[i], end[j] = k, 0
        if k < n:
            before[k] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


# --- ragged arrays ------------------------------------------------------------------------------


def taken(values: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``at`` one after the other, and their offsets; list i is values[offsets[i]:offsets[i + 1]]."""
    ends = np.zeros(len(at) + 1, np.int64)
    np.cumsum(np.diff(offsets).astype(np.int32)[at], out=ends[1:])
    out = np.empty(int(ends[-1]), values.dtype)
    for k in range(0, len(at), AT_ONCE):
        some = at[k : k + AT_ONCE]
        bounds = ends[k : k + len(some) + 1]
        place = np.arange(bounds[0], bounds[-1])
        place += np.repeat(offsets[some] - bounds[:-1], np.diff(bounds))
        out[bounds[0] : bounds[-1]] = values[place]
    return out, ends


def _packed(numbers: np.ndarray) -> bytes:
    """Four bytes a number, all lowest ones first, compressed; the size comes before."""
    planes = numbers.astype("<i4", copy=False).view(np.uint8).reshape(-1, 4).T.tobytes()
    return _shrunk(planes)


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(_grown(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _shrunk(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _grown(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


# --- encoding -----------------------------------------------------------------------------------

# One row of a block holds its documents, the others the words of one hash part, by rising slot.
_CUT = "block long, part int, doc_ids array<long>, counts array<int>, slots binary, words binary"
_CUT_KIND = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())),
                       ("slots", pa.binary()), ("words", pa.binary())])
_BETWEEN = b"\xff"  # in no UTF-8 text


def _cutter(pattern: str, parts: int, block_bytes: int):
    def block_rows(block: int, ids: list, slots: list[np.ndarray], known: dict[str, int]) -> list[dict]:
        counts, every = [len(s) for s in slots], np.concatenate(slots)
        slots.clear()
        order = np.argsort(-np.bincount(every, minlength=len(known)), kind="stable")  # frequent words first: small slots
        slot = np.empty(len(known), np.int32)
        slot[order] = np.arange(len(known))
        every = slot[every]
        rows = [{"block": block, "doc_ids": ids, "counts": counts, "slots": _packed(every)}]
        del every
        words = [w.encode() for w in known]
        words = [words[i] for i in order]
        part = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
        by_part = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[by_part], prepend=-1))
        for own in np.split(by_part, cuts[1:]) if len(words) else []:
            rows.append({"block": block, "part": int(part[own[0]]), "slots": _packed(np.diff(own, prepend=0)),
                         "words": _shrunk(_BETWEEN.join([words[i] for i in own]))})
        return rows

    def run(batches):
        import regex

        cut = regex.compile(pattern).findall
        block, size, ids, slots = TaskContext.get().partitionId() << 32, 0, [], []  # blocks of a task have numbers of their own
        known: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                found = cut(text)
                for w in set(found).difference(known):
                    known[w] = len(known)
                ids.append(doc_id)
                slots.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
                size += len(text)
                if size >= block_bytes:
                    yield pa.RecordBatch.from_pylist(block_rows(block, ids, slots, known), _CUT_KIND)
                    block, size, ids, slots = block + 1, 0, [], []
                    known.clear()
        if ids:
            yield pa.RecordBatch.from_pylist(block_rows(block, ids, slots, known), _CUT_KIND)

    return run


def _reassembled(docs: pa.Table, words: pa.Table) -> pa.Table:
    """Documents of one block: the ids of its words in place of the slots."""
    def column(name: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int32), *(_unpacked(x.as_py()) for x in words.column(name))])

    slot = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(_unpacked(x.as_py())) for x in words.column("slots"))])
    values, bounds = taken(column("ids"), np.concatenate([[0], np.cumsum(column("lengths"))]), np.argsort(slot, kind="stable"))
    values, bounds = taken(values, bounds, _unpacked(docs.column("slots")[0].as_py()))
    counts = docs.column("counts").combine_chunks().flatten().to_numpy()
    ends = bounds[np.concatenate([[0], np.cumsum(counts)])]
    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
    return pa.table([docs.column("doc_ids").combine_chunks().flatten(), ids], ["doc_id", "ids"])


def _word_ids(sent):
    def run(batches):
        known: dict[bytes, bytes] = {}  # ids as int32
        for batch in batches:
            ids, lengths = [], []
            for packed in batch.column("words"):
                words = _grown(packed.as_py()).split(_BETWEEN)
                if len(known) > KNOWN_WORDS:
                    known.clear()
                for w in words:
                    if w not in known:
                        known[w] = array("i", merged(w, sent.value)).tobytes()
                found = [known[w] for w in words]
                lengths.append(_packed(np.fromiter(map(len, found), np.int32, len(found)) // 4))
                ids.append(_packed(np.frombuffer(b"".join(found), np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("words_of"), batch.column("slots"), pa.array(lengths, pa.binary()), pa.array(ids, pa.binary())],
                ["words_of", "slots", "lengths", "ids"])

    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, block_bytes: int = BLOCK_BYTES, parts: int | None = None) -> DataFrame:
    """doc_id, ids: one row per row of ``docs``. ``pattern`` cuts texts into pre-tokens; ``parts`` is the
    number of tasks that encode words, by default set by the size of the input that Spark estimates."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if parts is None:
        parts = max(1, min(MOST_PARTS, -(-input_bytes(rows) // PART_BYTES)))
    with small_batches(docs.sparkSession):
        cut = _bucketed(spread(rows).mapInArrow(_cutter(pattern, parts, block_bytes), _CUT), parts)
    words = cut.where(F.col("part").isNotNull()).select(F.col("block").alias("words_of"), "part", "slots", "words")
    back = words.repartition(parts, "part").mapInArrow(_word_ids(sent), "words_of long, slots binary, lengths binary, ids binary")
    held = cut.where(F.col("part").isNull()).select("block", "doc_ids", "counts", "slots")
    return held.groupBy("block").cogroup(back.groupBy("words_of")).applyInArrow(_reassembled, "doc_id long, ids array<int>")


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` written by block, as a table of a name nobody else has in the shared folder."""
    name = f"slots_{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", fresh_path(df.sparkSession, "slots")).bucketBy(buckets, "block").saveAsTable(name)
    return df.sparkSession.table(name)


# --- decoding -----------------------------------------------------------------------------------


def decode(rows: DataFrame, ranks: dict[bytes, int], *, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the bytes of their tokens in the column ``into``."""
    into = unused(into, rows)
    size = max(ranks.values()) + 1
    tokens = [b""] * (size + 1)  # the last one is for ids that are none
    for token, rank in ranks.items():
        tokens[rank] = token
    sent = rows.sparkSession.sparkContext.broadcast(tokens)

    def run(batches):
        values = np.frombuffer(b"".join(sent.value), np.uint8)
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, sent.value), np.int64))])
        def decoded(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = batch.column(ids)
            at = lists.flatten()
            at = np.where(at.is_valid().to_numpy(zero_copy_only=False), at.fill_null(0).to_numpy(zero_copy_only=False), -1).astype(np.int64)
            at = np.where((at >= 0) & (at < size), at, size)
            data, ends = taken(values, bounds, at)
            count = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            null = pa.array(lists.is_null().to_numpy(zero_copy_only=False))
            column = pa.Array.from_buffers(
                pa.large_binary(), len(lists), [pc.invert(null).buffers()[1], pa.py_buffer(ends[count]), pa.py_buffer(data)])
            return pa.RecordBatch.from_arrays([*batch.columns, column.cast(pa.binary())], [*batch.schema.names, into])

        for batch in batches:  # a bounded number of ids at once, or one row
            ends = np.concatenate([[0], np.cumsum(batch.column(ids).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            a = 0
            while a < batch.num_rows:
                b = min(max(a + 1, int(np.searchsorted(ends, ends[a] + AT_ONCE, "right")) - 1), batch.num_rows)
                yield decoded(batch.slice(a, b - a))
                a = b

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(into, T.BinaryType())]))
