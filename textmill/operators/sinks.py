"""Corpus and sample sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import json_row
from .order import key_bucket, running_total

# About what a file of a corpus holds, and the rows in a file of a rank.
FILE_BYTES = 128 << 20
FILE_ROWS = 65_536


def write_corpus(df: DataFrame, path: str, order: list[str | Column], text: str = "text") -> None:
    """JSON lines in part files whose names sort as the rows do; what was there is replaced.

    Without ``order`` the rows stay in the order of their partitions.
    """
    ordered = df.select(*order, text).orderBy(*order) if order else df
    ordered.select(json_row(F.col(text)).alias("value")).write.mode("overwrite").text(path)


def file_of(rows: DataFrame, order: str, size: str, out: str = "file") -> tuple[DataFrame, int]:
    """Add the output file of each row, and say how many there are.

    A file takes the rows whose bytes begin in its share of all bytes, so files are equally large whatever the rows'
    sizes, and follow each other in ``order`` (a unique long). ``rows`` are narrow and staged.
    """
    total = rows.agg(F.sum(size)).first()[0] or 0
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    share = max(1, min(FILE_BYTES, -(-total // tasks)))
    summed = running_total(rows, F.col(size), "_end", [key_bucket(F.col(order))], [F.col(order)])
    placed = summed.withColumn(out, F.floor((F.col("_end") - F.col(size)) / share).cast("int")).drop("_end")
    return placed, max(1, -(-total // share))


def in_files(df: DataFrame, file: str, files: int, order: list[str]) -> DataFrame:
    """Rows in the partition of their file, sorted: places are known, so nothing has to be sampled."""
    return df.repartitionById(files, F.col(file)).sortWithinPartitions(*order)


def write_shards(samples: DataFrame, path: str, epochs: int, ranks: int, places: int) -> None:
    """Parquet by epoch and rank: a rank's file names, and rows in a file, are in feeding order.

    ``places`` is how many samples every rank has in an epoch. A partition is one file.
    """
    ranges = max(1, -(-places // FILE_ROWS))
    shard = F.col("epoch") * ranks + F.col("rank")
    held = samples.withColumn("_file", (shard * ranges + F.floor(F.col("place") / FILE_ROWS)).cast("int"))
    in_files(held, "_file", epochs * ranks * ranges, ["epoch", "rank", "place"]).drop("_file").write.mode("overwrite").partitionBy("epoch", "rank").parquet(path)
