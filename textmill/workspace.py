"""Where intermediate tables go, and what may be broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when it is counted and holds at most this many (narrow) rows.
BROADCAST_ROWS = 200_000
# Rows with long values that go to Python at once.
SMALL_BATCH = 1_000


def work_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only for local runs."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    base = tempfile.mkdtemp(prefix="textmill-")
    spark.sparkContext.setCheckpointDir(base)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to."""
    return f"{work_dir(spark)}/textmill/{uuid.uuid4().hex}/{name}"


class _Staged:
    """Paths of the tables written inside a ``staging`` block, and the block around it."""

    def __init__(self, outer: _Staged | None):
        self.outer, self.paths, self.tables = outer, [], []


_block: ContextVar[_Staged | None] = ContextVar("textmill_staged", default=None)


def block_path(spark: SparkSession, name: str) -> str:
    """A fresh path; what is written there is deleted at the end of the ``staging`` block, if there is one."""
    path, block = fresh_path(spark, name), _block.get()
    if block is not None:
        block.paths.append(path)
    return path


def _write(df: DataFrame, name: str, block: _Staged | None, folders: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    path = fresh_path(df.sparkSession, name)
    if block is not None:
        block.paths.append(path)  # before the write: a failed one leaves files, too
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()  # made for this table alone
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    The copy has no lineage, survives the loss of executors and is pruned by column, so
    later passes over a few narrow columns do not repeat the work that made them.
    """
    return _write(df, name, _block.get())[0]


def stage_by_task(df: DataFrame, name: str) -> DataFrame:
    """``stage`` with two more columns: ``task``, which wrote the row, and ``row``, unique and rising within a task.

    The copy is a table bucketed by task: a task fills one bucket, so it writes one file. A join on (task, row) that
    runs under ``joined_by_task`` then leaves these rows where they are and moves the other side only.
    """
    spark, block = df.sparkSession, _block.get()
    path, table = fresh_path(spark, name), f"{name}_{uuid.uuid4().hex}"
    if block is not None:
        block.paths.append(path)
        block.tables.append(table)
    tagged = df.withColumn("row", F.monotonically_increasing_id())
    tagged = tagged.withColumn("task", F.shiftright("row", 33).cast("int"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged.write.format("parquet").option("path", path).bucketBy(buckets, "task").saveAsTable(table)
    return spark.table(table)


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def joined_by_task(spark: SparkSession):
    """Joins planned inside accept rows that are together by ``task`` alone."""
    return _set(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def small_batches(spark: SparkSession):
    """Jobs run inside hand Python at most ``SMALL_BATCH`` rows at a time.

    For rows of several kilobytes: a batch is held by the JVM and by the worker, and doubled while it is written.
    """
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    return _set(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(min(rows, SMALL_BATCH) if rows > 0 else SMALL_BATCH))


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are deleted at its end, also when it fails.

    What is read later has to be written elsewhere or with ``keep``.
    """
    block = _Staged(_block.get())
    token = _block.set(block)
    try:
        yield
    finally:
        _block.reset(token)
        for table in block.tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in block.paths:
            _delete(spark, path)


def keep(df: DataFrame, name: str) -> DataFrame:
    """``stage`` for a table that outlives the ``staging`` block around it (and lives as long as the next one)."""
    block = _block.get()
    return _write(df, name, block.outer if block else None)[0]


class Rewritten:
    """A table that is written again and again; a version goes as soon as its successor is written.

    ``folders`` names columns whose values are folders of their own, which a filter on them leaves unread.
    """

    def __init__(self, df: DataFrame, name: str, folders: tuple[str, ...] = ()):
        self.name, self.folders = name, folders
        self.df, self._path = _write(df, name, _block.get(), folders)

    def replace(self, df: DataFrame) -> DataFrame:
        old = self._path
        self.df, self._path = _write(df, self.name, _block.get(), self.folders)
        _delete(df.sparkSession, old)
        return self.df


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small input to all cores.

    A scan cannot cut a Parquet row group, so a few megabytes may arrive as one task and keep it
    busy for long with text work. An input that fills the cores with full splits is left alone.
    """
    spark = df.sparkSession
    tasks = spark.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(tasks) if size < tasks * split else df


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the counted rows allow it, else leave the join to the planner.

    Meant for staged tables, where counting reads only file footers.
    """
    if df.count() <= limit:
        return F.broadcast(df)
    return df
