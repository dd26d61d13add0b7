"""Epoch shuffle, rank shards and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import stage
from .order import position


def shuffle_key(seed: int, epoch: Column, row: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), row.cast("string")))


def epoch_order(ids: DataFrame, row: str, epochs: int, seed: int = 42) -> DataFrame:
    """``epoch, row, pos``: a new permutation of the rows in every epoch.

    Hashes spread evenly over buckets by their first digits, so no bucket grows hot.
    """
    every = ids.select(row, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    keyed = every.withColumn("_h", shuffle_key(seed, F.col("epoch"), F.col(row)))
    prefix = F.substr("_h", F.lit(1), F.lit(4))
    return position(keyed, "pos", [prefix], [F.col("_h"), F.col(row)], ["epoch"]).select("epoch", row, "pos")


def rank_shards(ordered: DataFrame, row: str, ranks: int) -> DataFrame:
    """Deal positions to ranks in turn; the last round is filled from the start of the epoch.

    Gives ``epoch, rank, place, row`` with the same number of places for every rank.
    """
    rows = F.lit(ordered.where("epoch = 0").agg(F.count("*")).scalar())
    places = F.ceil(rows / ranks).cast("long") * ranks
    dealt = ordered.select("epoch", row, F.explode(F.sequence(F.col("pos"), places - 1, rows)).alias("_p"))
    return dealt.select(
        "epoch", F.pmod(F.col("_p"), F.lit(ranks)).cast("int").alias("rank"),
        F.floor(F.col("_p") / ranks).cast("long").alias("place"), row,
    )


def shard_rows(ids: DataFrame, row: str, ranks: int, epochs: int = 1, seed: int = 42) -> DataFrame:
    """``epoch_order`` and ``rank_shards`` on a table of row ids."""
    return rank_shards(stage(epoch_order(ids, row, epochs, seed), "epoch_order"), row, ranks)


def batches(shards: DataFrame, batch_size: int, columns: list[str]) -> DataFrame:
    """Consecutive rows of a rank as one batch; the last one may be short.

    A group has at most ``batch_size`` rows.
    """
    return (
        shards.groupBy("epoch", "rank", F.floor(F.col("place") / batch_size).cast("long").alias("batch_id"))
        .agg(F.sort_array(F.collect_list(F.struct("place", *columns))).alias("_rows"))
        .select("epoch", "rank", "batch_id", *[F.col(f"_rows.{c}").alias(c) for c in columns])
    )
