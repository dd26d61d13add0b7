"""Operators that depend on the order of rows, without one sorted task.

A running total over the whole table is built from two levels: totals per bucket of the order
key, a running total over those (one row per bucket), and a window inside each bucket. A bucket
is a range of the order key with a bounded number of rows, so no task sees more than that, and
it does not matter how many rows one source, file or key holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import broadcast_if_small, stage

# Order keys per bucket. Keys are unique, so a bucket never holds more rows than this.
BUCKET_KEYS = 65_536


def key_bucket(order: Column) -> Column:
    """The bucket of a unique integer order key: the first key it can hold."""
    return order.cast("long") - F.pmod(order.cast("long"), F.lit(BUCKET_KEYS))


def running_total(
    df: DataFrame,
    value: Column,
    out: str,
    buckets: Sequence[Column],
    order: Sequence[Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``out``, the sum of ``value`` over this row and all before it (within ``by``).

    ``buckets`` sort before ``order``. The offset join and the window use the same keys, so
    rows are shuffled once; ``value`` has to be an integer for sums to be the same every run.
    """
    names = [f"_b{i}" for i in range(len(buckets))]
    keys = [*by, *names]
    rows = df.withColumns({**dict(zip(names, buckets)), "_v": value.cast("long")})
    totals = rows.groupBy(*keys).agg(F.sum("_v").alias("_t"))
    before = Window.partitionBy(*by).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.col("_o") + F.sum("_v").over(inside)
    return rows.join(offsets, keys).withColumn(out, total).drop(*names, "_v", "_o")


def position(
    df: DataFrame, out: str, buckets: Sequence[Column], order: Sequence[Column], by: Sequence[str] = ()
) -> DataFrame:
    """Add ``out``, the 0-based place of each row in the order (within ``by``)."""
    counted = running_total(df, F.lit(1), out, buckets, order, by)
    return counted.withColumn(out, F.col(out) - 1)


def block_sequence(df: DataFrame, keys: Sequence[str], pos: str, out: str = "seq") -> DataFrame:
    """Turn a source's order key into one long that sorts the same way.

    Blocks (one row per file block) are ranked, the row's place in its block fills the low bits.
    ``df`` has to be staged: the block table is made from it and joined back.
    """
    blocks = df.select(*keys).distinct()
    ranked = stage(blocks.select(*keys, F.row_number().over(Window.orderBy(*keys)).alias("_rank")), "blocks")
    low = F.col(pos).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        df.join(broadcast_if_small(ranked), list(keys))
        .withColumn(out, F.shiftleft(F.col("_rank").cast("long"), 33).bitwiseOR(low))
        .drop("_rank")
    )


def prefix_end(keyed: DataFrame, order: str, weight: str, limit: int) -> DataFrame:
    """One row, ``_end``: the order key of the first row that takes the sum of weights over ``limit``.

    NULL when the sum stays within it. Only the bucket in which this happens is looked at row by row.
    """
    bucketed = keyed.select(F.col(order).alias("_k"), F.col(weight).alias("_w")).withColumn("_b", key_bucket(F.col("_k")))
    totals = bucketed.groupBy("_b").agg(F.sum("_w").alias("_t"))
    reached = totals.withColumn("_sum", F.sum("_t").over(Window.orderBy("_b")))
    crossing = reached.where(F.col("_sum") > limit).agg(
        F.min("_b").alias("_b"), F.min_by(F.col("_sum") - F.col("_t"), "_b").alias("_o")
    )
    rows = bucketed.join(F.broadcast(crossing), "_b")  # an ungrouped aggregate: one row
    inside = Window.partitionBy("_b").orderBy("_k")
    return (
        rows.withColumn("_sum", F.col("_o") + F.sum("_w").over(inside))
        .where(F.col("_sum") > limit)
        .agg(F.min("_k").alias("_end"))
    )


def take_prefix(df: DataFrame, order: str, weight: Column, limit: int) -> DataFrame:
    """Rows in order up to, and without, the first that takes the sum of weights over ``limit``.

    0 or less means no limit. Rows themselves are not shuffled: only (key, weight) pairs are
    written and summed, then a comparison with one key cuts ``df``.
    """
    if limit <= 0:
        return df
    keyed = stage(df.select(F.col(order).alias("k"), weight.cast("long").alias("w")), "weights")
    end = prefix_end(keyed, "k", "w", limit).scalar()
    return df.where(F.coalesce(F.col(order) < end, F.lit(True)))


def byte_budget(df: DataFrame, order: str, row_bytes: Column, max_bytes: int) -> DataFrame:
    """The prefix whose rows fit into ``max_bytes``; a later, smaller row is not tried."""
    return take_prefix(df, order, row_bytes, max_bytes)


def first_docs(df: DataFrame, order: str, max_docs: int) -> DataFrame:
    """The first ``max_docs`` rows; 0 or less means all."""
    return take_prefix(df, order, F.lit(1), max_docs)


def concat_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """All rows of all sources, repeats kept; ``src_ord`` is the place of the source."""
    tagged = [df.withColumn("src_ord", F.lit(i)) for i, df in enumerate(sources)]
    return reduce(DataFrame.unionByName, tagged)


def concat_position(df: DataFrame, order: str, out: str = "place") -> DataFrame:
    """The place of each row when sources follow one another."""
    return position(df, out, [F.col("src_ord"), key_bucket(F.col(order))], [F.col(order)])


# Arrival times are whole numbers of 2**-20, so that sums are exact in any order of addition.
TICKS = 1 << 20


def arrival_step(seed: int, source: Column, k: Column) -> Column:
    """An exponential waiting time in ticks for record ``k`` of a source, from a hash."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), source.cast("string"), k.cast("string")))
    uniform = (F.conv(F.substr(digest, F.lit(1), F.lit(8)), 16, 10).cast("double") + 1) / float(1 << 32)
    return F.floor(-F.log(uniform) * TICKS).cast("long") + 1


def mix_sources(df: DataFrame, source: str, order: str, seed: int = 42, out: str = "place") -> DataFrame:
    """Interleave sources at random: the next record comes from each unfinished source alike.

    Every source is a Poisson stream of the same rate; rows in order of arrival are such an
    interleaving, each source keeping its own order. The result depends on the seed only.
    """
    in_source = [key_bucket(F.col(order))]
    keyed = stage(df.select(source, order), "mix_keys")
    placed = position(keyed, "_k", in_source, [F.col(order)], [source])
    step = arrival_step(seed, F.col(source), F.col("_k"))
    arriving = stage(running_total(placed, step, "_at", in_source, [F.col(order)], [source]), "arrivals")
    # About BUCKET_KEYS rows arrive in a slot when this many sources are running.
    running = keyed.select(source).distinct().count()
    # The width is divided, not the time multiplied: times of very long sources would leave the range of a long.
    slot = F.floor(F.col("_at") / F.lit(max(1, BUCKET_KEYS * TICKS // max(running, 1)))).cast("long")
    placed = position(arriving, out, [slot], [F.col("_at"), F.col(source)])
    return df.join(placed.select(source, order, out), [source, order])
