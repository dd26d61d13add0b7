import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textmill.operators import dedupe, feed, order


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(order, "BUCKET_KEYS", 7)


def rows(spark, n, parts):
    df = spark.range(n).select((F.col("id") * 3).alias("k"), (F.col("id") * 37 % 11 + 1).alias("w"),
                               F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("text"))
    return df.repartition(parts)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_running_total_and_position(spark, small_buckets, parts):
    df = rows(spark, 100, parts)
    got = {r.k: (r.total, r.place) for r in order.position(
        order.running_total(df, F.col("w"), "total", [order.key_bucket(F.col("k"))], [F.col("k")]),
        "place", [order.key_bucket(F.col("k"))], [F.col("k")]).collect()}
    sums = list(itertools.accumulate(i * 37 % 11 + 1 for i in range(100)))
    assert got == {3 * i: (sums[i], i) for i in range(100)}


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_prefix_at_every_budget(spark, small_buckets, parts):
    df = rows(spark, 40, parts)
    weights = [i * 37 % 11 + 1 for i in range(40)]
    sums = list(itertools.accumulate(weights))
    for limit in (1, sums[9] - 1, sums[9], sums[9] + 1, sums[-1] - 1, sums[-1], 10_000, 0):
        got = sorted(r.k for r in order.byte_budget(df, "k", F.col("w"), limit).collect())
        n = 40 if limit == 0 else sum(s <= limit for s in sums)
        assert got == [3 * i for i in range(n)], limit
    assert sorted(r.k for r in order.first_docs(df, "k", 5).collect()) == [0, 3, 6, 9, 12]


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_dedupe_keeps_the_first(spark, parts):
    df = rows(spark, 60, parts)
    got = sorted(r.k for r in dedupe.dedupe_first(df, "text", "k").collect())
    assert got == [3 * i for i in range(60) if i == 0 or i % 3]
    marked = {r.k: r.repeated for r in dedupe.mark_repeats(df, dedupe.digest(F.col("text")), "k").collect()}
    assert marked == {3 * i: bool(i and i % 3 == 0) for i in range(60)}


def mixed(spark, sizes, seed, parts=3):
    data = [(s, i) for s, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(data, "s int, k long").repartition(parts)
    return [(r.s, r.k) for r in order.mix_sources(df, "s", "k", seed).orderBy("place").collect()]


def test_mix_keeps_each_source_in_order(spark, small_buckets):
    sizes = (50, 3, 20)
    base = mixed(spark, sizes, 5)
    for source, size in enumerate(sizes):
        assert [k for s, k in base if s == source] == list(range(size))
    assert mixed(spark, sizes, 5, parts=16) == base
    assert mixed(spark, sizes, 6) != base


def test_mix_odds(spark):
    """Many independent pairs of sources with 2 and 1 records: the single record is first in half
    of the cases, in the middle in a quarter."""
    n = 4_000
    df = spark.range(n).select(F.explode(F.array(*[
        F.struct(F.concat(F.lit(name), F.col("id").cast("string")).alias("s"), F.col("id").alias("g"), F.lit(k).alias("k"))
        for name, k in (("a", 0), ("a", 1), ("b", 0))])).alias("r")).select("r.*")
    placed = order.mix_sources(df.select("s", "k"), "s", "k", 1).withColumn("g", F.substr("s", F.lit(2)))
    order_of = placed.groupBy("g").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(
        "place", F.substr("s", F.lit(1), F.lit(1)).alias("n")))), lambda x: x["n"]), "").alias("o"))
    seen = Counter(r.o for r in order_of.collect())
    assert sum(seen.values()) == n
    assert abs(seen["baa"] / n - 0.5) < 0.04 and abs(seen["aba"] / n - 0.25) < 0.04


def test_mix_of_very_long_sources(spark, monkeypatch):
    """Arrival times near the end of a long do not overflow when they are dealt to slots."""
    monkeypatch.setattr(order, "arrival_step", lambda seed, source, k: F.lit((1 << 63) // 8) + k)
    got = mixed(spark, (7, 5), 1)
    assert Counter(s for s, _ in got) == {0: 7, 1: 5} and [k for s, k in got if s == 0] == list(range(7))


def test_block_sequence_sorts_like_its_key(spark):
    df = spark.createDataFrame([(f, b, (p << 33) + i) for f in ("b", "a") for b, p in ((0, 3), (64, 1)) for i in range(3)],
                               "f string, b long, pos long")
    got = [(r.f, r.b, r.pos) for r in order.block_sequence(df, ["f", "b"], "pos").orderBy("seq").collect()]
    assert got == sorted(got) and len(got) == 12


@pytest.mark.parametrize("n,ranks", [(10, 3), (9, 3), (2, 5), (1, 4), (7, 1)])
def test_shards(spark, n, ranks):
    ids = spark.range(n).withColumnRenamed("id", "row")
    got = feed.shard_rows(ids, "row", ranks, epochs=2).collect()
    per = -(-n // ranks)
    for epoch in (0, 1):
        mine = [r for r in got if r.epoch == epoch]
        dealt = {(r.place, r.rank): r.row for r in mine}
        assert len(dealt) == len(mine) == per * ranks
        line = [dealt[k] for k in sorted(dealt)]
        assert sorted(line[:n]) == list(range(n))
        assert line == [line[i % n] for i in range(per * ranks)]
    if n == 10:
        assert {(r.rank, r.place, r.row) for r in got if r.epoch == 0} != {(r.rank, r.place, r.row) for r in got if r.epoch == 1}
    again = feed.shard_rows(ids.repartition(5), "row", ranks, epochs=2).collect()
    assert set(again) == set(got)


def test_batches(spark):
    shards = feed.shard_rows(spark.range(11).withColumnRenamed("id", "row"), "row", 2)
    rows_of = {(r.rank, r.place): r.row for r in shards.collect()}
    for b in feed.batches(shards, 4, ["row"]).collect():
        places = range(b.batch_id * 4, min(b.batch_id * 4 + 4, 6))
        assert b.row == [rows_of[b.rank, p] for p in places]
