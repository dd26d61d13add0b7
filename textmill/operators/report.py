"""Counters over a build."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEPT, SHORT, REPEAT = "kept", "short", "repeat"


def corpus_report(status: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Counters over rows with ``status`` (kept, short, repeat) and ``row_bytes``."""
    def rows(value: str) -> Column:
        return F.count_if(F.col("status") == value)

    written = F.coalesce(F.sum(F.when(F.col("status") == KEPT, F.col("row_bytes"))), F.lit(0))
    return status.groupBy(*by).agg(
        rows(KEPT).alias("saved"),
        rows(SHORT).alias("skipped"),
        rows(REPEAT).alias("duplicated"),
        written.alias("written_bytes"),
        F.round(written / float(1024**3), 2).alias("size_gb"),
    )


def training_steps(samples: DataFrame, batch_size: int, grad_accum: int, ranks: int = 1, epochs: int = 1) -> DataFrame:
    """Sample count, batches per epoch and rank, and optimizer steps."""
    def per(count: Column, size: int) -> Column:
        return F.ceil(count / size).cast("long")

    return (
        samples.agg(F.count("*").alias("samples"))
        .withColumn("rank_samples", per(F.col("samples"), ranks))
        .withColumn("batches", per(F.col("rank_samples"), batch_size))
        .withColumn("steps_per_epoch", per(F.col("batches"), grad_accum))
        .withColumn("total_steps", F.col("steps_per_epoch") * epochs)
    )
