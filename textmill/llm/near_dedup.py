"""MinHash near-dedup by a chosen-path set similarity join.

A document is the set of its distinct word shingles. Documents with equal sets are one class and
take part once. In each of TREES trees a node of documents branches by a selected minwise token: documents
that agree on the value of a minwise function go to the same child. Each level of each tree has a function of its own,
so trees are independent. A node with few documents is compared on the
signatures; a larger one branches again. A node that stays large after DEPTH branches is dealt to parts of about BLOCK
documents by a hash of tree and document, and every part is compared with every part: its documents all meet.
Pairs found are confirmed on the full sets, and confirmed links are joined to components.

In a group of more than ALL_PAIRS documents this takes two rounds. The first confirms pairs that join what is most
alike. Where a node still holds likely pairs that these links have not joined, the second brings the full sets of their documents
there, counts what all of them share at once and gives the links of a spanning forest: fewer rows than documents, however
many pairs are alike. A node with more sets than TILE_ROWS or TILE_BYTES is dealt to parts that meet each other.

A pair of similarity s meets in one tree with probability s to the depth of its leaf, which is DEPTH at most;
18 trees miss a pair at 0.85 with a probability below 0.00001 and one at 0.80 below 0.0001.

Words are runs of bytes other than white space (space, tab to carriage return), A-Z lower-cased.

Defined results. A null or empty text, or one without words, has no shingles and is linked with
nothing. With fewer words than a shingle has, the whole sequence is the one shingle. Rows that
repeat an id are one document. A null id is linked with nothing and stays. Only doc_id and text are
read; further columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import broadcast_if_small, small_batches, stage
from .components import components
from .sizes import unused
from .words import Slice, grams, mixed, slices, word_hashes, words

SHINGLE = 5
PERCENT = 85
TREES = 18
DEPTH = 4
SIGNATURE = TREES * DEPTH
LEAF = 64
BLOCK = 512
ALL_PAIRS = 16
FORESTS = 3
PAIRS_AT_ONCE = 128
TILE_ROWS, TILE_BYTES = 1024, 1 << 24
FEW, COLUMNS = 32, 1024

_FACTORS = mixed(np.arange(1, SIGNATURE + 1, dtype=np.uint64)) | np.uint64(1)
_ADDED = mixed(np.arange(1001, SIGNATURE + 1001, dtype=np.uint64))


def shingle_sets(s: Slice, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of the slice's texts, one after the other, and where each text's begin."""
    w = words(s)
    hashes = word_hashes(s, w, lower=True)
    count = np.diff(w.first)
    found = [grams(hashes, w.first, n)]
    for short in range(1, n):  # texts of so few words
        only = np.flatnonzero(count == short)
        if len(only):
            part = np.concatenate([hashes[w.first[i] : w.first[i + 1]] for i in only])
            h, t = grams(part, np.arange(len(only) + 1) * short, short)
            found.append((mixed(h + np.uint64(short)), only[t]))
    h, t = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((h, t))
    h, t = h[order], t[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    h, t = h[fresh], t[fresh]
    return h, np.searchsorted(t, np.arange(len(s) + 1))


def _signed(batches):
    for batch in batches:
        ids = batch.column("id")
        for s in slices(batch.column("text")):
            h, first = shingle_sets(s)
            size = np.diff(first)
            full = np.flatnonzero(size)
            at = first[:-1][full]
            low = np.zeros((len(s), SIGNATURE), np.uint32)
            both = np.zeros((len(s), 2), np.uint64)
            if len(full):
                with np.errstate(over="ignore"):
                    for k in range(SIGNATURE):
                        low[full, k] = np.minimum.reduceat(h * _FACTORS[k] + _ADDED[k], at) >> np.uint64(32)
                    both[full, 0] = np.add.reduceat(h, at)
                    both[full, 1] = np.add.reduceat(mixed(h), at)
            none = size == 0
            yield pa.RecordBatch.from_arrays([
                ids.slice(s.first, len(s)), pa.array(size.astype(np.int64)),
                pa.array([x.tobytes() for x in both], pa.binary(), mask=none),
                pa.array([x.tobytes() for x in low], pa.binary(), mask=none),
                pa.array([x.tobytes() for x in low.astype(np.uint8)], pa.binary(), mask=none),
            ], ["id", "n", "set", "signature", "sketch"])


def signatures(docs: DataFrame) -> DataFrame:
    """id, n (size of the set), set (a hash of all of it), signature (4 bytes a function), sketch (1 byte a function)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_signed, "id long, n long, set binary, signature binary, sketch binary")


def leaves(classes: DataFrame) -> DataFrame:
    """(node, part, own, many, id): the groups in which documents are compared, of all trees.

    Where a group is two parts of a large node, ``own`` is the document's part: those of one part meet elsewhere.
    ``many`` tells nodes of more than ALL_PAIRS documents.
    """
    def child(node, depth, signature):
        function = (F.col("tree") - 1) * DEPTH + depth - 1
        return F.xxhash64(node, signature.substr((function * 4 + 1).cast("int"), F.lit(4)))

    roots = classes.select("id", "signature", F.explode(F.sequence(F.lit(1), F.lit(TREES))).alias("tree"))
    rows = roots.select("id", "tree", "signature", F.xxhash64(F.lit("root"), "tree").alias("node"))
    found = []
    for depth in range(1, DEPTH + 1):
        rows = stage(rows.select("id", "tree", child(F.col("node"), depth, F.col("signature")).alias("node")), "branches")
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = stage(rows.join(sizes, "node"), "nodes")
        found.append(rows.where(F.col("n") <= LEAF).select("node", F.lit(0).cast("long").alias("part"), F.lit(0).alias("own"), (F.col("n") > ALL_PAIRS).alias("many"), "id"))
        rows = rows.where(F.col("n") > LEAF)
        if depth == DEPTH or not rows.limit(1).count():
            break
        rows = rows.join(classes.select("id", "signature"), "id")
    parts = F.ceil(F.col("n") / BLOCK)
    rows = rows.select("node", "id", parts.alias("parts"), F.pmod(F.xxhash64("tree", "id"), parts).cast("int").alias("own"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))))
    part = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    found.append(rows.select("node", part.cast("long").alias("part"), "own", F.lit(True).alias("many"), "id"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def estimates(own: np.ndarray, sizes: np.ndarray, low: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Estimated similarity of the documents of one group; 0 where it is five deviations below the threshold."""
    s = percent / 100
    least = s - 5 * (s * (1 - s) / SIGNATURE) ** 0.5
    same = np.zeros((len(own), len(own)), np.uint8)
    for function in np.ascontiguousarray(low.T):
        same += function[:, None] == function
    estimate = (same / np.float32(low.shape[1]) - 1 / 256) / (1 - 1 / 256)
    few, many = np.minimum(sizes[:, None], sizes), np.maximum(sizes[:, None], sizes)
    estimate[(100 * few < percent * many) | (estimate < least)] = 0
    np.fill_diagonal(estimate, 0)
    if (own != own[0]).any():
        estimate[own[:, None] == own] = 0
    return estimate


def first_pairs(estimate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs to confirm first: all likely ones of a very small group.

    Of a larger one those of FORESTS spanning forests of the most similar pairs, and those of the
    document that is most like all others.
    """
    if len(estimate) <= ALL_PAIRS:
        return np.nonzero(np.triu(estimate))
    hub = int(np.argmax(estimate.sum(1)))
    out = [(hub, j) for j in np.flatnonzero(estimate[hub])]
    estimate = estimate.copy()
    for _ in range(FORESTS):
        left, best, near = np.ones(len(estimate), bool), np.full(len(estimate), -1.0), np.zeros(len(estimate), int)
        taken = []
        while left.any():
            i = int(np.argmax(np.where(left, best, -2)))
            if best[i] > 0:
                taken.append((i, near[i]))
            left[i] = False
            closer = estimate[i] > best
            best[closer], near[closer] = estimate[i][closer], i
        for i, j in taken:
            estimate[i, j] = estimate[j, i] = 0
        out += taken
    i, j = np.array(out, int).reshape(-1, 2).T
    return i, j


def _runs(batches, keys):
    """Consecutive rows with equal keys, as one table each."""
    held, at = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if key != at and held:
                yield pa.Table.from_batches(held)
                held = []
            at = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _pairs(found: list) -> pa.RecordBatch:
    a, b = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _likely(group: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a group's documents and the estimates of its pairs."""
    ids, own, sizes = (group.column(c).to_numpy() for c in ("id", "own", "n"))
    low = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
    return ids, estimates(own, sizes, low, percent)


def _compared(percent: int):
    def run(batches):
        found, n = [], 0
        for group in _runs(batches, ("node", "part")):
            if group.num_rows < 2:
                continue
            ids, estimate = _likely(group, percent)
            i, j = first_pairs(estimate)
            found.append((np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])))
            n += len(i)
            if n > 10_000:
                yield _pairs(found)
                found, n = [], 0
        yield _pairs(found)

    return run


def _unjoined(percent: int):
    """Documents that have a likely pair in their group which the links so far do not join."""
    def run(batches):
        for group in _runs(batches, ("node", "part")):
            joined = group.column("component").to_numpy()
            if (joined == joined[0]).all():
                continue
            ids, estimate = _likely(group, percent)
            estimate[joined[:, None] == joined] = 0
            ids = ids[estimate.any(1)]
            node = np.full(len(ids), group.column("node")[0].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(ids)], ["node", "id"])

    return run


def _in_place(groups: DataFrame, run, schema: str) -> DataFrame:
    return groups.repartition("node", "part").sortWithinPartitions("node", "part").mapInArrow(run, schema)


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """By pair of sets, how many elements they share. Elements of FEW sets are counted by pair, others by matrix product."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, element, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True, return_counts=True)
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    both = np.zeros(n * n, np.int64)
    rare = (count[element] > 1) & (count[element] <= FEW)
    who, what = owner[rare], element[rare]
    codes, held = [], 0
    for apart in range(1, FEW):
        at = np.flatnonzero(what[apart:] == what[:-apart])
        if not len(at):
            break
        codes.append(who[at] * n + who[at + apart])
        held += len(at)
        if held > 1 << 21:
            both += np.bincount(np.concatenate(codes), minlength=n * n)
            codes, held = [], 0
    if codes:
        both += np.bincount(np.concatenate(codes), minlength=n * n)
    both = both.reshape(n, n)
    both += both.T
    often = count[element] > FEW
    who, what = owner[often], np.cumsum(np.diff(element[often], prepend=-1) != 0) - 1
    for first in range(0, int(what[-1]) + 1 if len(what) else 0, COLUMNS):
        a, b = np.searchsorted(what, (first, first + COLUMNS))
        holds = np.zeros((n, COLUMNS), np.float32)
        holds[who[a:b], what[a:b] - first] = 1
        both += (holds @ holds.T).astype(np.int64)
    return both


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect whatever all links connect: at most one fewer than documents."""
    left, out = np.ones(len(linked), bool), []
    for start in range(len(linked)):
        if not left[start]:
            continue
        left[start], waiting = False, [start]
        while waiting:
            i = waiting.pop()
            found = np.flatnonzero(linked[i] & left)
            left[found] = False
            out += [(i, j) for j in found]
            waiting += found.tolist()
    return out


def _linked(percent: int):
    """Links on full sets between documents of one group that are not in one component yet, as a spanning forest."""
    def run(batches):
        for group in _runs(batches, ("node", "part")):
            ids, joined = (group.column(c).to_numpy() for c in ("id", "component"))
            if (joined == joined[0]).all():
                continue
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("hashes")]
            sizes, both = np.array([len(x) for x in sets]), shared(sets)
            linked = 100 * both >= percent * (sizes[:, None] + sizes - both)
            linked &= joined[:, None] != joined
            found = np.array(forest(linked), int).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ids[found[:, k]]) for k in (0, 1)], ["a", "b"])

    return run


def _whole_sets(batches):
    for batch in batches:
        ids = batch.column("id")
        for s in slices(batch.column("text")):
            h, first = shingle_sets(s)
            yield pa.RecordBatch.from_arrays([
                ids.slice(s.first, len(s)),
                pa.array([h[x:y].tobytes() for x, y in zip(first, first[1:])], pa.binary())], ["id", "hashes"])


def _confirmed(percent: int):
    def run(batches):
        one = {}
        for batch in batches:
            a, salt, b = (batch.column(c).to_pylist() for c in ("a", "salt", "b"))
            sets = batch.column("hashes")
            got = ([], [])
            for i in range(batch.num_rows):
                here = np.frombuffer(sets[i].as_buffer(), np.uint64)
                if b[i] is None:
                    if one.get("key") != (a[i], salt[i]):
                        one = {"key": (a[i], salt[i]), "set": here.copy()}
                    continue
                if one.get("key") != (a[i], salt[i]):
                    continue
                both = len(np.intersect1d(one["set"], here, assume_unique=True))
                if 100 * both >= percent * (len(one["set"]) + len(here) - both):
                    got[0].append(a[i])
                    got[1].append(b[i])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], ["a", "b"])

    return run


def whole_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, hashes) of the documents in ``ids`` (_id)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(broadcast_if_small(ids), F.col("id") == F.col("_id"), "left_semi")
    return stage(rows.mapInArrow(_whole_sets, "id long, hashes binary"), "sets")


def confirmed(docs: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    The set of ``a`` meets those of at most about PAIRS_AT_ONCE partners in one place.
    """
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_AT_ONCE).cast("int").alias("salts"))
    ids = stage(pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).distinct(), "paired")
    sets = whole_sets(docs, ids)
    hubs = degree.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"))
    spokes = pairs.join(degree, "a").select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), "b")
    met = sets.join(hubs.unionByName(spokes), "id").select("a", "salt", "b", "hashes")
    met = met.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return met.mapInArrow(_confirmed(percent), "a long, b long").distinct()


def confirmed_in_place(docs: DataFrame, rest: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that join what the full sets of ``rest`` (node, id, n, component) link inside their nodes."""
    sets = whole_sets(docs, rest.select(F.col("id").alias("_id")).distinct())
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / TILE_ROWS), F.ceil(8 * F.sum("n") / TILE_BYTES)).cast("int")
    dealt = rest.join(rest.groupBy("node").agg(parts.alias("parts")), "node")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node", "id"), "parts").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    part = F.least("own", "other").cast("long") * F.col("parts") + F.greatest("own", "other")
    blocks = dealt.select("node", part.alias("part"), "id", "component")
    # A row that repeats an id has its set twice; a forest ignores that.
    return _in_place(blocks.join(sets, "id"), _linked(percent), "a long, b long").where("a != b").distinct()


def near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept. Documents of ``percent`` similarity are linked."""
    with small_batches(docs.sparkSession):  # texts and whole sets are long
        return _near_copies(docs, percent)


def _near_copies(docs: DataFrame, percent: int) -> DataFrame:
    signed = stage(signatures(docs), "signatures")
    full = signed.where("n > 0 AND id IS NOT NULL")
    classes = stage(full.groupBy("n", "set").agg(F.min("id").alias("id"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch")), "classes")
    groups, sketches = leaves(classes), classes.select("id", "n", "sketch")
    pairs = stage(_in_place(groups.join(sketches, "id"), _compared(percent), "a long, b long").distinct(), "pairs")
    links = stage(confirmed(docs, pairs, percent), "links")
    larger = stage(groups.where("many").drop("many"), "larger")
    if larger.limit(1).count():
        joined = stage(components(links), "joined")
        again = larger.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id")).join(sketches, "id")
        rest = stage(_in_place(again, _unjoined(percent), "node long, id long").distinct(), "unjoined")
        rest = rest.join(sketches.select("id", "n"), "id").join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
        links = links.unionByName(stage(confirmed_in_place(docs, stage(rest, "rest"), percent), "links"))
    # Equal sets, and rows that repeat an id, are links too.
    members = full.groupBy("n", "set", "id").agg(F.count(F.lit(1)).alias("rows")).join(classes.select("n", "set", F.col("id").alias("first")), ["n", "set"])
    equal = members.where("id != first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    groups = stage(components(links.unionByName(equal)), "components")
    return signed.join(groups, "id", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, with all their columns."""
    name = unused("_dropped", docs)
    dropped = stage(near_copies(docs, percent).where("NOT kept").select(F.col("doc_id").alias(name)).distinct(), "dropped")
    return docs.join(broadcast_if_small(dropped), docs["doc_id"].cast("long") == F.col(name), "left_anti")
