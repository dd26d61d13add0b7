"""Exact deduplication that keeps the first copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def digest(text: Column) -> Column:
    """16 bytes that stand for a text."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def first_copies(df: DataFrame, order: str, key: Column) -> DataFrame:
    """Order keys of the first row of every distinct ``key``.

    A hash aggregate with a long per group, combined before the shuffle: a text with any number
    of copies reaches the final task as one row per map task.
    """
    return df.groupBy(key.alias("_digest")).agg(F.min(order).alias(order)).select(order)


def dedupe_first(df: DataFrame, text: str, order: str) -> DataFrame:
    """Keep the first row of every distinct text. ``order`` is unique and long."""
    return df.join(first_copies(df, order, digest(F.col(text))), order, "left_semi")


def mark_repeats(df: DataFrame, key: Column, order: str, out: str = "repeated") -> DataFrame:
    """Add whether an earlier row has the same key. Joined on the unique order key, so no
    group of copies meets in one task."""
    first = first_copies(df, order, key).withColumn("_first", F.lit(True))
    return df.join(first, order, "left").withColumn(out, F.col("_first").isNull()).drop("_first")
