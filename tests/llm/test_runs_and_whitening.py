"""Byte-level BPE, whitening and periodic runs."""

from __future__ import annotations

import hashlib
import math
import random
import tracemalloc
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from textmill.llm import byte_bpe, periodic, queries, whitening

SF_DIR = "/root/testdata/sf0.001"


def sha(text) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# --- periodic runs ----------------------------------------------------------------------------


def plain_runs(words: list) -> list[tuple]:
    """(start, length, period) from every stretch of equal words a period apart; the smallest period of a stretch counts."""
    n, found, smallest = len(words), [], {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and (i, j + q) not in smallest:
                smallest[i, j + q] = q
                found.append((i, j + q - i, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, plant: bool) -> tuple:
    w = plain.WORD.findall(text or "")
    n = len(w)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *shown, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_brute_force(seed):
    turn = random.Random(seed)
    letters = turn.choice([1, 2, 3, 30])
    words = [turn.randrange(letters) for _ in range(turn.randrange(0, 90))]
    for _ in range(turn.randrange(4)):  # stretches that repeat, at any place, with a cut-off end
        some = [turn.randrange(letters) for _ in range(turn.randint(1, 9))]
        at = turn.randrange(len(words) + 1)
        words[at:at] = (some * turn.randint(2, 9))[: turn.randint(1, 60)]
    got = list(zip(*(x.tolist() for x in periodic.find_runs(np.array(words, np.int64)))))
    assert got == plain_runs(words)


def test_runs_of_long_periodic_text():
    some = np.random.default_rng(1).integers(0, 1000, 777)
    assert [x.tolist() for x in periodic.find_runs(np.tile(some, 200))] == [[0], [777 * 200], [777]]
    assert [x.tolist() for x in periodic.find_runs(np.zeros(100_000, np.int64))] == [[0], [100_000], [1]]
    with pytest.raises(ValueError):
        periodic.find_runs(some, least_exponent=2)


def test_runs_of_odd_rows(spark):
    rows = plain.odd_rows() + [(100, "a b " * 50, "en", None, 1), (101, "x " * 6, None, None, 1), (102, "x " * 5, None, None, 1),
                               (103, "a b c " * 4 + "z " + "d e " * 9, None, None, None), (104, "é é " * 9, None, None, None)]
    got = periodic.periodic_runs(plain.table(spark, rows)).collect()
    want = [(i, len(plain.WORD.findall(t or "")), plain_runs(plain.WORD.findall(t or ""))) for i, t, *_ in rows]
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs]) for r in got), key=str) == sorted(want, key=str)
    collapsed = {r.doc_id: r.collapsed for r in got}
    assert collapsed[100] == "a b" and collapsed[101] == "x" and collapsed[102] == "x x x x x" and collapsed[103] == "a b c z d e"
    assert collapsed[104] == "é é" and collapsed[1] == ""
    assert periodic.periodic_runs(plain.table(spark, [])).collect() == []


def test_op13_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op13_periodic_runs"](spark, SF_DIR)
    assert got.columns[:6] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    assert all(t == "bigint" for c, t in got.dtypes[:6])
    got = sorted(map(tuple, got.collect()))
    assert got == sorted(plain_row(r.doc_id, r.text, True) for r in docs) and any(r[1] for r in got)


def test_planting_of_odd_rows(spark):
    rows = [(i, t, "en", None, None) for i in range(60) for t in (None, "", "a b c d e f g h i j k l", "one")] + [(None, "a b", "x", None, None)]
    found = periodic.periodic_runs(periodic.with_planted_run(plain.table(spark, rows)))
    best = found.withColumn("b", periodic.strongest(F.col("runs"))).select("doc_id", F.size("runs"), "b.start", "b.length", "b.period", "collapsed")
    want = [plain_row(i, t, True) for i, t, *_ in rows]
    assert sorted(((*r[:5], sha(r[5])) for r in best.collect()), key=str) == sorted(((*r[:5], r[7]) for r in want), key=str)


# --- byte-level BPE -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bpe():
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.load(queries.tokenizer_path(queries.MULTI_BPE))
    return ranks, public_tokenizers.PATTERN, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_words_equal_the_library(bpe):
    ranks, _, library = bpe
    turn = random.Random(3)
    words = ["a", "hello", " the", "é", "\U0001f600", "日本語", "aaaa", "a" * 500, "ab" * 3000, "=-" * 200, "\x00\x01", " " * 70, "xyzzy" * 40]
    words += ["".join(turn.choice("abcdeé日 ") for _ in range(turn.randint(1, 150))) for _ in range(300)]
    for w in words:
        want = library.encode_single_token(w) if w.encode() in ranks else library._core_bpe.encode_single_piece(w.encode())
        assert byte_bpe.merged(w.encode(), ranks) == ([want] if isinstance(want, int) else want)
        if len(w.encode()) > 1 and w.encode() not in ranks:
            assert byte_bpe._merged_long(w.encode(), ranks) == want


@pytest.mark.parametrize("block, parts", [(1, 5), (2000, 3), (byte_bpe.BLOCK_BYTES, None)])
def test_encoding_equals_the_library(spark, docs, bpe, block, parts, monkeypatch):
    if parts:
        monkeypatch.setattr(byte_bpe, "KNOWN_WORDS", 50)
    ranks, pattern, library = bpe
    odd = [*plain.odd_rows(), (200, "<|endoftext|> a <|endoftext|>", None, None, None), (201, "tab\tand\r\n\n  spaces   　x", None, None, None),
           (202, "don't we'll I'VE 3rd ½² ﬁ", None, None, None), (203, "=-" * 4000, None, None, None)]
    odd += [(r.doc_id + 1000, r.text, None, None, None) for r in docs.limit(60).collect()]
    rows = byte_bpe.encode(plain.table(spark, odd), ranks, pattern, block_bytes=block, parts=parts)
    got = [(r.doc_id, r.ids, bytes(r.decoded)) for r in byte_bpe.decode(rows, ranks).collect()]
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in odd]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_encoding_of_an_empty_table(spark, bpe):
    ranks, pattern, _ = bpe
    rows = byte_bpe.decode(byte_bpe.encode(plain.table(spark, []), ranks, pattern), ranks)
    assert rows.columns == ["doc_id", "ids", "decoded"] and rows.collect() == []


def test_every_distinct_word_is_encoded_once(spark, bpe, monkeypatch):
    """Copies, frequent words and many blocks: the encoder is given each word once."""
    ranks, pattern, _ = bpe
    df = spark.range(4000).selectExpr("id doc_id", "'the the cat' text")
    seen, merged = spark.sparkContext.accumulator(0), byte_bpe.merged

    def counted(word, ranks):
        seen.add(1)
        return merged(word, ranks)

    monkeypatch.setattr(byte_bpe, "merged", counted)
    assert len({tuple(r.ids) for r in byte_bpe.encode(df, ranks, pattern, block_bytes=500, parts=4).collect()}) == 1 and seen.value == 3


def test_slots_are_not_shuffled(spark, docs, bpe):
    ranks, pattern, _ = bpe
    plan = byte_bpe.encode(docs, ranks, pattern, parts=6)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(block" not in plan and "Bucketed: true" in plan


def test_blocks_are_put_together_in_little_memory():
    """What ``taken`` holds on the way, besides the three values of each place: numpy reports its arrays to tracemalloc."""
    values, offsets, at = np.arange(3000, dtype=np.int32), np.arange(0, 3001, 3), np.arange(1 << 20) % 1000
    tracemalloc.start()
    got = byte_bpe.taken(values, offsets, at)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got.reshape(-1, 3) == at[:, None] * 3 + np.arange(3)).all()
    assert peak < 36 * len(at)


def test_decoding_of_odd_ids(spark, bpe):
    ranks, _, library = bpe
    rows = spark.createDataFrame([(1, [0, None, 5]), (2, None), (3, []), (4, [-1, 10**6, 7])], "decoded int, ids array<int>")
    got = {r.decoded: r.decoded_ for r in byte_bpe.decode(rows, ranks).collect()}
    token = library.decode_single_token_bytes
    assert got == {1: token(0) + token(5), 2: None, 3: b"", 4: token(7)}
    assert byte_bpe.decode(rows.where("false"), ranks).collect() == []


def test_op11_equals_the_library(spark, bpe):
    _, _, library = bpe
    want = set()
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(r.text or "")))
    got = queries.QUERIES["op11_byte_bpe"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and set(map(tuple, got.collect())) == want


# --- whitening ----------------------------------------------------------------------------------


def some_matrix(kind: str, d: int) -> np.ndarray:
    turn = np.random.default_rng(d)
    if kind == "random":
        a = turn.standard_normal((d, d))
        return a @ a.T
    if kind == "equal":  # every eigenvalue twice
        q, _ = np.linalg.qr(turn.standard_normal((d, d)))
        return q @ np.diag(np.repeat(np.arange(1.0, d + 1), 2)[:d]) @ q.T
    if kind == "identity":
        return np.eye(d) * 3
    if kind == "low rank":
        a = turn.standard_normal((d, max(1, d // 3)))
        return a @ a.T
    if kind == "close":
        q, _ = np.linalg.qr(turn.standard_normal((d, d)))
        return q @ np.diag(1 + 1e-9 * np.arange(d)) @ q.T
    return np.zeros((d, d))


@pytest.mark.parametrize("kind", ["random", "equal", "identity", "low rank", "close", "zero"])
@pytest.mark.parametrize("d", [1, 2, 3, 9, 64])
def test_principal_components(kind, d):
    a = some_matrix(kind, d)
    k = min(8, d)
    values, x = whitening.principal(a, k)
    size = max(np.abs(a).sum(1).max(), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() <= 1e-13 * size * d
    assert np.abs(x.T @ x - np.eye(k)).max() < 1e-12
    assert np.abs(a @ x - x * values).max() <= 1e-13 * size * d


def plain_whitened(vectors: list[tuple], k: int = 8) -> tuple:
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in vectors], np.int64)
    n, s = len(x), x.sum(0)
    y = x - s / n
    values, basis = np.linalg.eigh(y.T @ y / n)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return n, deviation, y @ basis / np.sqrt(values), values / np.trace(y.T @ y / n)


def checked(rows, vectors: list[tuple]) -> None:
    n, deviation, w, explained = plain_whitened(vectors)
    k = w.shape[1]
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) == len(vectors) * k
    sign = None
    for (vec_id, _), dev, want in zip(vectors, deviation, w):
        own = [got[vec_id, c + 1] for c in range(k)]
        have = np.array([r.whitened for r in own])
        if sign is None:
            sign = np.sign(have * want)
        assert np.allclose(have, want * sign, atol=1e-6)
        assert {r.deviation for r in own} == {dev if dev < 2**63 else None} and {r.n for r in own} == {n}
        assert np.allclose([r.explained for r in own], explained, rtol=1e-9)
        assert all(r.identity_error < 1e-6 for r in own)


def test_op12_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    out = queries.QUERIES["op12_whitening"](spark, SF_DIR)
    assert out.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
                          ("explained", "double"), ("identity_error", "double")]
    checked(out.collect(), [(r.vec_id, r.embedding) for r in rows])


def test_whitening_of_odd_vectors(spark):
    turn = np.random.default_rng(5)
    good = [(i, turn.standard_normal(12).tolist()) for i in range(200)]
    good += [(300 + i, [0.25] * 12) for i in range(30)]
    bad = [(900, None), (901, []), (902, [1.0, None] * 6), (903, [float("nan")] * 12), (904, [1.0] * 11 + [float("-inf")]), (905, [1.0, 2.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("vector", "n", "i", "component", "row")})
    checked(whitening.whitened(df).collect(), good)
    checked(whitening.whitened(df.repartition(7)).collect(), good)
    assert whitening.whitened(df.where("false")).collect() == []
    assert whitening.whitened(df.where("vec_id in (900, 901)")).collect() == []
    # Fewer rows than components, equal rows, repeated and null ids.
    one = whitening.whitened(df.where("vec_id = 3")).collect()
    assert len(one) == 8 and {(r.whitened, r.explained, r.deviation, r.identity_error, r.n) for r in one} == {(0.0, 0.0, 0, 0.0, 1)}
    three = whitening.whitened(df.where("vec_id < 3"), 4).collect()
    assert len(three) == 12 and {r.component for r in three if r.explained == 0} == {3, 4} and all(r.identity_error < 1e-9 for r in three)
    twice = spark.createDataFrame([(None, [1.0, 2.0]), (1, [2.0, 0.5]), (1, [0.0, 0.25])], "vec_id long, embedding array<double>")
    assert sorted((str(r.vec_id), r.component) for r in whitening.whitened(twice).collect()) == [("1", 1), ("1", 1), ("1", 2), ("1", 2), ("None", 1), ("None", 2)]


def test_whitening_of_huge_entries(spark):
    rows = [(i, [1e300 * (-1) ** i, 3e15 * i, 1.0]) for i in range(4)]
    out = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(out) == 12 and all(math.isfinite(r.whitened) for r in out) and {r.deviation for r in out} == {None}


def test_deviation_is_exact(spark):
    rows = [(i, [2.0**30 + i * 2.0**-10, -(2.0**29)]) for i in range(5)]
    out = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 1).collect()
    assert {(r.vec_id, r.deviation) for r in out} == {(i, (5 * i - 10) ** 2) for i in range(5)}
