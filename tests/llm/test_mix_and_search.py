"""Mixing, search, the pipeline and the registered queries."""

from __future__ import annotations

import importlib.util
import math
import shutil
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from tests.oracle import difference
from textmill.llm import mixing, pieces, quality, queries, topk

SF_DIR = "/root/testdata/sf0.001"


def plain_targets(sizes: dict) -> dict:
    """Share by weight, cut at twice the size, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in over)
        free -= over
    return target


def test_targets(spark):
    sizes = {"b": 1000, "a": 10, "Z": 300, None: 90, "ä": 5000, "c": 0, "d": 77}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in want)


def test_permutation(spark):
    for n in (1, 2, 7, 1000):
        rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), [F.lit(3)], 1).alias("p"))
        got = [r.p for r in rows.collect()]
        assert sorted(got) == list(range(n))
        assert n < 1000 or sum(a == b for a, b in enumerate(got)) < n / 20


def mixed(df, **options):
    return sorted((tuple(r) for r in mixing.taken_words(df, **options).collect()), key=str)


@pytest.mark.parametrize("slots", [mixing.SHARD_SLOTS, 16])
def test_mix(spark, slots):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = mixed(docs, block_words=8, shard_slots=slots)
    assert got == mixed(docs.repartition(7).sortWithinPartitions("doc_id").select("*", F.lit(1).alias("_row")), block_words=8, shard_slots=slots)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    source = {r.doc_id: (r.source, len(plain.WORD.findall(r.text or ""))) for r in docs.collect()}
    for doc_id, n, source_size, goal, got_words in got:
        assert n == source[doc_id][1] and 0 <= got_words <= 2 * n
        s = source[doc_id][0]
        size[s] += n
        taken[s] += got_words
        target[s] = goal
        assert source_size == sum(k for x, k in source.values() if x == s)
    want = plain_targets(size)
    assert all(math.isclose(target[s], want[s], rel_tol=1e-9) and abs(taken[s] - want[s]) <= 16 for s in want)


def test_draws_meet_quotas(spark):
    sources = spark.createDataFrame([(1, 500), (2, 0), (3, 1500), (4, 1)], "s int, quota long")
    counts = mixing.shard_counts(sources, 2001, 42, 100).collect()
    by_shard, by_source = defaultdict(int), defaultdict(int)
    for r in counts:
        by_shard[r.shard] += r.n
        by_source[r.s] += r.n
    assert by_shard == {**{i: 100 for i in range(20)}, 20: 1} and by_source == {1: 500, 3: 1500, 4: 1}
    assert len({r.n for r in counts if r.s == 1}) > 3  # drawn, not dealt


def test_mix_of_odd_rows(spark):
    odd = plain.table(spark, plain.odd_rows())
    got = mixing.taken_words(odd, block_words=4).collect()
    assert len(got) == odd.count() and all(r.taken <= 2 * r.size for r in got)
    assert {r.taken for r in got if r.size == 0} == {0}
    rows = mixing.mixed_documents(odd, block_words=4)
    assert rows.columns == odd.columns
    words = defaultdict(int)
    for r in rows.collect():
        words[r.doc_id] += len(plain.WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    taken = defaultdict(int)
    for r in got:
        taken[r.doc_id] += r.taken
    # Rows that repeat an id are numbered anew, so only sums of the sources are the same.
    assert sum(words.values()) == sum(taken.values())
    assert mixing.taken_words(plain.table(spark, [])).collect() == []
    assert mixing.mixed_documents(plain.table(spark, [])).collect() == []
    none = plain.table(spark, [(1, None, "en", "a", None), (2, " ", "en", None, 1)])
    assert {(r.doc_id, r.target, r.taken) for r in mixing.taken_words(none).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


def test_mixed_documents_are_runs_of_words(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    taken = {r.doc_id: r.taken for r in mixing.taken_words(docs).collect()}
    words = defaultdict(int)
    for r in mixing.mixed_documents(docs).collect():
        assert r.text in text[r.doc_id]
        words[r.doc_id] += len(plain.WORD.findall(r.text))
    assert {i: n for i, n in taken.items() if n} == words


def broadcast_joins(df) -> list:
    """The broadcast joins of the plan that ran."""
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in ran
    return [line for line in ran.splitlines() if "BroadcastHashJoin" in line or "BroadcastNestedLoopJoin" in line]


def test_blocks_and_texts_are_not_broadcast(spark):
    """What grows with the words must not go through the driver, however few ranges of slots it is made from."""
    few = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
                                 F.repeat(F.lit("word "), 2000).alias("text"))
    for rows, sides in ((mixing.mixed_documents(few, block_words=2), ("block#", "_row#")), (mixing.taken_words(few, block_words=2), ("block#",))):
        assert not [line for line in broadcast_joins(rows) if any(x in line for x in sides)]


def test_slots_drawn_anew_are_not_broadcast(spark):
    sources = spark.createDataFrame([(i, 30) for i in range(1, 101)], "s int, quota long")
    assert not [line for line in broadcast_joins(mixing.shard_counts(sources, 3000, 42, 100)) if "[x#" in line]


def plain_top(vectors: list, is_query, k: int = 10) -> Counter:
    """Of every row that is a query, its k best among all other rows, those that repeat its id included."""
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors]
    out = Counter()
    for row, (q, own) in enumerate(whole):
        if is_query(q):
            scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for n, (i, v) in enumerate(whole) if n != row and len(v) == len(own))
            out.update((q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k]))
    return out


def test_top_k_of_odd_vectors(spark, monkeypatch):
    import random

    turn = random.Random(4)
    good = {i: [turn.gauss(0, 1) for _ in range(6)] for i in range(300)}
    good |= {i: [0.5] * 6 for i in range(300, 420)}  # one common vector: ties
    good |= {500: [1.0, 2.0], 501: [-1.0, 0.25], 600: [3.0], 700: [1e12, -1e11], 800: [0.0] * 6}
    good = [*good.items(), (300, [0.5] * 6), (100, [0.25] * 6), (100, [2.0] * 6), (1, [2.0] * 6), (1, [-1.0] * 6)]
    rows = good + [(900, None), (901, []), (902, [1.0, None]), (903, [float("nan")] * 6), (904, [float("inf")] * 6), (None, [1.0] * 6)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("x", "q", "shard", "vector", "rank", "row", "asking")})
    monkeypatch.setattr(topk, "SHARD_ROWS", (40, 100))
    got = Counter(tuple(r) for r in topk.top_k(docs, F.col("vec_id") % 100 == 0).collect())
    assert got == plain_top(good, lambda i: i % 100 == 0)
    assert topk.top_k(docs.where("false"), F.lit(True)).collect() == []
    few = spark.createDataFrame([(1, [1.0, 1.0]), (1, [2.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(few, F.lit(True)).collect()] == [(1, 1, 1, 2097152)] * 2


def test_sql_of_repeated_ids(spark, tmp_path):
    import random

    turn = random.Random(5)
    rows = [(i % 60 * 10, [turn.gauss(0, 1) for _ in range(4)]) for i in range(180)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1).write.parquet(f"{tmp_path}/written")
    shutil.copy(next((tmp_path / "written").glob("part-*.parquet")), tmp_path / "embeddings.parquet")
    for name in ("documents", "conversations"):  # the views of difference()
        shutil.copy(f"{SF_DIR}/{name}.parquet", tmp_path)
    assert difference(queries.QUERIES["op5_top_k"](spark, str(tmp_path)), queries.ORACLES["op5_top_k"], str(tmp_path)) is None


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    if name in queries.ORACLES:
        assert difference(df, queries.ORACLES[name], SF_DIR) is None
    else:
        assert df.collect()


pipeline_there = importlib.util.find_spec("corpus_pipeline") is not None


@pytest.mark.skipif(not pipeline_there, reason="the pipeline is not there")
def test_pipeline(spark):
    """Every stage against a plain version that works on the rows it was given."""
    import corpus_pipeline
    from textmill.workspace import stage

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, SF_DIR), name)
        before, after = ([tuple(r) for r in df.collect()] for df in (docs, out))
        if name != "encode":
            assert out.columns == docs.columns
        if name == "quality":
            scores = {r.doc_id: r.score for r in quality.score(docs, queries.quality_model(docs, SF_DIR)).collect()}
            assert sorted(after) == sorted(r for r in before if scores[r[0]] >= 0.3) and len(after) < len(before)
        elif name == "exact_dedup":
            stays = {k[0] for k in plain.exact(before) if k[3]}
            assert sorted(after) == sorted(r for r in before if r[0] in stays) and len(after) < len(before)
        elif name == "near_dedup":
            stays = {i for i, (_, c) in plain.near(before, 80).items() if i == c}
            assert sorted(after) == sorted(r for r in before if r[0] in stays)
        elif name == "mix":
            taken = {r.doc_id: r.taken for r in mixing.taken_words(docs).collect() if r.taken}
            words = defaultdict(int)
            for r in after:
                words[r[0]] += len(plain.WORD.findall(r[1]))
            assert words == taken
        else:
            v = pieces.load(queries.tokenizer_path(queries.PIECES))
            assert out.columns == [*docs.columns, "ids"] and len(after) == len(before)
            assert all(pieces.decode(v, np.array(r[-1])) == r[1] for r in after)
        docs = out
