"""Broadcast only what was measured; objects that travel with their code; names that are free."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 48 << 20


def sent_if_small(df: DataFrame, width: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if the sum of ``width`` (bytes of a row) over the written ``df`` is within ``limit``."""
    size = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def handed_out(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast ``value`` with the code of its classes; a task calls the result once and keeps the object while it runs.

    Workers need not have the package, and between tasks they hold the packed bytes only.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def unused(name: str, df: DataFrame) -> str:
    """``name``, made longer until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# Estimates beyond this are Spark's way to say that it does not know.
UNKNOWN_BYTES = 1 << 50


def input_bytes(df: DataFrame, text: str = "text") -> int:
    """About how many bytes ``df`` has: the size of its files as Spark estimates it, else the counted bytes of ``text``."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < UNKNOWN_BYTES else df.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
