"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The pieces and log scores come from a SentencePiece model file whose path is a parameter; the trie
and the tables are built once on the driver and sent to the tasks (their size is that of the
vocabulary). White space is marked with U+2581, and a marker is put before a text that is not empty. Among all ways
to cut a text into pieces the one with the highest sum of scores is taken; of equal ones the one whose
last pieces begin earlier. A character that is no piece by itself may be unknown, at ten below the lowest score, and
is written as its UTF-8 bytes when the model has byte pieces. Decoding turns byte pieces into
characters (bytes that are no UTF-8 into U+FFFD), markers into spaces and takes the first marker away.

A text is cut before markers and around characters that no longer piece holds, where no piece can
reach across, so the best cut of the parts is the best cut of the whole. A task remembers the parts
it has met; new ones are solved together as numpy arrays: all positions walk the trie at once, then
all parts take the same step of the Viterbi recursion at once. Texts are taken, new parts are solved and rows leave
a worker in groups of bounded size (one longer text or part is a group of its own).

Defined results. A null text counts as empty and has no pieces. A U+2581 in a text comes back as a space.
Repeated rows get equal results. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .sizes import handed_out

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_BYTES = 24 << 20  # of the parts a task remembers
PART_BYTES = 250  # of a part and its ids, besides their own bytes
TEXTS_AT_ONCE = 256
GROUP_BYTES = 1 << 20  # of the texts that are taken at once
SOLVED_CHARS = 1 << 17  # of the parts that are solved at once; the arrays take some 200 bytes for each
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6  # kinds of pieces in the model file


@dataclass
class Trie:
    """A double array: the child of state s by byte c is base[s] + c if check of that is s."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, keys: dict[bytes, int]) -> Trie:
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for key, v in keys.items():
            node = 0
            for c in key:
                node = children[node].setdefault(c, len(children))
                if node == len(children):
                    children.append({})
                    values.append(-1)
            values[node] = v
        size = 2 * len(children) + 1024
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free = np.ones(size, bool)
        free[0] = False
        place, low = {0: 0}, 1
        for node in range(len(children)):  # parents come before their children
            kids = children[node]
            state = place.pop(node)
            value[state] = values[node]
            if not kids:
                continue
            codes = np.fromiter(sorted(kids), np.int64)
            low += int(np.argmax(free[low:]))
            b = begin = max(1, low - int(codes[0]))
            while not free[b + codes].all():
                b += 1
            low += (b - begin) // 8  # leave crowded places behind
            base[state] = b
            for c in codes:
                free[b + c], check[b + c] = False, state
                place[kids[int(c)]] = b + int(c)
            if b + 600 > len(free):
                free, check = np.append(free, np.ones(size, bool)), np.append(check, np.full(size, -1, np.int32))
                base, value = np.append(base, np.zeros(size, np.int32)), np.append(value, np.full(size, -1, np.int32))
        return cls(base, check, value)


@dataclass
class Vocabulary:
    trie: Trie
    score: np.ndarray
    text: list[bytes]  # what each piece gives when decoded; markers are still in it
    is_byte: np.ndarray
    byte_id: np.ndarray  # by byte, -1 without byte pieces
    unknown: int
    unknown_score: float
    longest: int
    parts: str
    prefix: bool
    silent: frozenset = field(default_factory=frozenset)


def load(path: str) -> Vocabulary:
    """Read a model file; only models that leave texts as they are (no character map) are taken."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
        raise ValueError("the model changes texts before it cuts them")
    return vocabulary([(p.piece, p.score, p.type) for p in model.pieces], spec.add_dummy_prefix)


def vocabulary(pieces: list[tuple[str, float, int]], prefix: bool = True) -> Vocabulary:
    byte_id = np.full(256, -1, np.int32)
    text, keys = [], {}
    for i, (piece, _, kind) in enumerate(pieces):
        if kind == BYTE:
            byte_id[int(piece[3:5], 16)] = i
            text.append(bytes([int(piece[3:5], 16)]))
        else:
            text.append(piece.encode() if kind in (NORMAL, USER) else b"")
            if kind in (NORMAL, USER):
                keys[piece.encode()] = i
    normal = [p for p, _, kind in pieces if kind in (NORMAL, USER)]
    scores = np.array([s for _, s, _ in pieces], float)
    together = {c for p in normal if len(p) > 1 for c in p}
    alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in together)
    cut = not any(MARK in p.lstrip(MARK) for p in normal)
    body = f"{MARK}*[^{MARK}{alone}]+|{MARK}+" if cut else f"[^{alone}]+" if alone else r"[\s\S]+"
    lowest = min((s for _, s, kind in pieces if kind == NORMAL), default=0.0)
    return Vocabulary(
        Trie.of(keys), scores, text, np.array([kind == BYTE for _, _, kind in pieces]), byte_id,
        next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0), lowest - UNKNOWN_PENALTY,
        max(map(len, keys), default=0), body + (f"|[{alone}]" if alone else ""), prefix)


def _edges(v: Vocabulary, data: np.ndarray, end_of: np.ndarray):
    """All (start, end, id) at which a piece lies in ``data``; end_of: where the part of each byte ends."""
    head = (data & 0xC0) != 0x80  # first bytes of characters
    start = np.flatnonzero(head)
    width = np.diff(np.append(start, len(data)))
    known = np.zeros(len(start), bool)
    out = []
    which, state = np.arange(len(start)), np.zeros(len(start), np.int64)
    for step in range(v.longest):
        at = start[which] + step
        live = at < end_of[start[which]]
        which, state, at = which[live], state[live], at[live]
        if not len(which):
            break
        to = v.trie.base[state] + data[at].astype(np.int64)
        live = v.trie.check[to] == state
        which, state = which[live], to[live]
        value = v.trie.value[state]
        hit = value >= 0
        out.append((start[which[hit]], start[which[hit]] + step + 1, value[hit]))
        known[which[hit & (width[which] == step + 1)]] = True
    rest = ~known
    out.append((start[rest], start[rest] + width[rest], np.full(int(rest.sum()), -1)))
    return (np.concatenate(x) for x in zip(*out))


def best_cuts(v: Vocabulary, parts: list[str]) -> list[bytes]:
    """The ids of every part as int32 bytes."""
    raw = [p.encode() for p in parts]
    length = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum(length)
    begins = ends - length
    start, end, piece = _edges(v, data, np.repeat(ends, length))
    part = np.searchsorted(ends, start, "right")
    gain = np.where(piece >= 0, v.score[piece], v.unknown_score)
    order = np.lexsort((start, part, end - begins[part]))
    start, end, piece, gain = start[order], end[order], piece[order], gain[order]
    node_start, node_end = start + part[order], end + part[order]  # one node more than bytes in each part
    depth = end - begins[part[order]]
    best = np.full(len(data) + len(raw), -np.inf)
    best[begins + np.arange(len(raw))] = 0.0
    back = np.full(len(best), -1)
    cuts = np.flatnonzero(np.diff(depth, prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(depth))):
        total = best[node_start[a:b]] + gain[a:b]
        first = np.flatnonzero(np.diff(node_end[a:b], prepend=-1))
        top = np.maximum.reduceat(total, first)
        hits = np.flatnonzero(total == np.repeat(top, np.diff(np.append(first, b - a))))
        chosen = hits[np.unique(node_end[a:b][hits], return_index=True)[1]]
        best[node_end[a:b][first]] = top
        back[node_end[a:b][chosen]] = a + chosen
    at = ends + np.arange(len(raw))
    root = begins + np.arange(len(raw))
    steps = []
    live = np.arange(len(raw))
    while len(live):
        edge = back[at[live]]
        steps.append((live, edge))
        at[live] = node_start[edge]
        live = live[at[live] > root[live]]
    owner, edge = (np.concatenate(x) for x in zip(*steps[::-1])) if steps else (np.zeros(0, int),) * 2
    order = np.argsort(owner, kind="stable")
    owner, edge = owner[order], edge[order]
    ids = piece[edge].astype(np.int32)
    cuts = np.searchsorted(owner, np.arange(len(raw) + 1))
    out = [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
    for i in np.unique(owner[ids < 0]):
        spelled = []
        for e in edge[cuts[i] : cuts[i + 1]]:
            spelled += [piece[e]] if piece[e] >= 0 else _spelled(v, data[start[e] : end[e]])
        out[i] = np.array(spelled, np.int32).tobytes()
    return out


def _spelled(v: Vocabulary, character: np.ndarray) -> list[int]:
    ids = v.byte_id[character]
    return list(ids) if (ids >= 0).all() else [v.unknown]


def _groups(parts: list[str], limit: int) -> Iterator[list[str]]:
    """``parts`` in order, cut into lists of about ``limit`` characters."""
    group, size = [], 0
    for p in parts:
        if group and size + len(p) > limit:
            yield group
            group, size = [], 0
        group.append(p)
        size += len(p)
    if group:
        yield group


class Encoder:
    """Encodes texts; remembers parts of about CACHE_BYTES, and starts anew beyond that."""

    def __init__(self, v: Vocabulary):
        self.v, self.known, self.held, self.cut = v, {}, 0, re.compile(v.parts).findall

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t.replace(" ", MARK) if t else "" for t in texts]
        parts = [self.cut(MARK + t if t and self.v.prefix else t) for t in texts]
        new = set().union(*parts).difference(self.known)
        if self.held > CACHE_BYTES:
            self.known, self.held, new = {}, 0, set().union(*parts)
        for some in _groups(sorted(new), SOLVED_CHARS):
            cuts = best_cuts(self.v, some)
            self.known.update(zip(some, cuts))
            self.held += PART_BYTES * len(some) + sum(map(len, some)) + sum(map(len, cuts))
        return [b"".join(map(self.known.__getitem__, p)) for p in parts]


def decode(v: Vocabulary, ids: np.ndarray) -> str:
    raw = b"".join(map(v.text.__getitem__, ids.tolist()))
    mark = MARK.encode()
    if v.prefix and raw.startswith(mark) and len(ids) and not v.is_byte[ids[0]]:
        raw = raw[len(mark) :]
    return raw.decode("utf-8", "replace").replace(MARK, " ")


def _encoded(column: pa.Array, encoder: Encoder) -> Iterator[list[bytes]]:
    """Ids of the texts in order, some rows at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(column):
        fit = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GROUP_BYTES, "right"))
        to = min(max(at + 1, fit), at + TEXTS_AT_ONCE)
        yield encoder.encode(column.slice(at, to - at).to_pylist())
        at = to


def encode(docs: DataFrame, v: Vocabulary, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out`` (array<int>), the ids of ``text``; a column of that name is replaced."""
    sent = handed_out(docs.sparkSession, v)
    docs = docs.select(*(c for c in docs.columns if c != out))
    schema = StructType([*docs.schema.fields, StructField(out, ArrayType(IntegerType()))])
    position = docs.columns.index(text)

    def run(batches):
        encoder = Encoder(sent())
        for batch in batches:
            at = 0
            for rows in _encoded(batch.column(position), encoder):
                offsets = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rows]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(rows), np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.slice(at, len(rows)).columns, ids], names=[*batch.schema.names, out])
                at += len(rows)

    return docs.mapInArrow(run, schema)


def decoded(rows: DataFrame, v: Vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the text of ``ids`` (null stays null)."""
    sent = handed_out(rows.sparkSession, v)
    rows = rows.select(*(c for c in rows.columns if c != out))
    schema = StructType([*rows.schema.fields, StructField(out, StringType())])
    position = rows.columns.index(ids)

    def run(batches):
        v = sent()
        for batch in batches:
            texts = [None if x is None else decode(v, np.array(x, np.int32)) for x in batch.column(position).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return rows.mapInArrow(run, schema)


def round_trips(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """doc_id, n_ids, n_byte_ids, ids_sha256 (of the ids as little-endian int32), decoded_sha256, exact."""
    sent = handed_out(docs.sparkSession, v)

    def run(batches):
        v = sent()
        encoder = Encoder(v)
        for batch in batches:
            column, at = batch.column("text"), 0
            for group in _encoded(column, encoder):
                rows = []
                for raw in group:
                    ids = np.frombuffer(raw, np.int32)
                    text, back = column[at].as_py() or "", decode(v, ids)
                    rows.append((len(ids), int(v.is_byte[ids].sum()), hashlib.sha256(raw).hexdigest(),
                                 hashlib.sha256(back.encode()).hexdigest(), back == text.replace(MARK, " ")))
                    at += 1
                ids = batch.column("doc_id").slice(at - len(rows), len(rows))
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(x) for x in zip(*rows))],
                    ["doc_id", "n_ids", "n_byte_ids", "ids_sha256", "decoded_sha256", "exact"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_ids long, n_byte_ids long, ids_sha256 string, decoded_sha256 string, exact boolean")
