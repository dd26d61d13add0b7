"""Exact dedup by stateful streaming: one keyed state per distinct text, kept on disk, never expired.

The arriving rows are written as a narrow table (id, digest, content locator). A stream reads that
table and keeps, for each digest, the smallest id, where its content lies and how many rows had it.
The state lives in the RocksDB store of Structured Streaming, so it is bounded by disk, is
checkpointed to the shared folder and survives the loss of an executor. A hit is then checked byte
by byte against the text of the row that stays; texts that merely share a digest (none with SHA-256)
are grouped by their full bytes instead.

Defined results. A null text counts as empty. A null id sorts after every other id. Rows that repeat
both id and text are copies of each other: one of them stays. Further columns of ``docs`` take no
part and may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..workspace import block_path, broadcast_if_small, stage
from .sizes import unused

# Rows of one group that meet the text of the row that stays in one place.
SALT_ROWS = 512
_STORE = "spark.sql.streaming.stateStore."
_STATE_SETTINGS = {
    _STORE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _STORE + "rocksdb.changelogCheckpointing.enabled": "true",
    _STORE + "rocksdb.boundedMemoryUsage": "true",
    _STORE + "rocksdb.maxMemoryUsageMB": "128",
    _STORE + "maintenanceInterval": "15s",  # how soon executors close the stores of a stream that has ended
    _STORE + "rocksdb.allowFAllocate": "false",  # else each state partition reserves megabytes of disk it does not use
}
_ENTRY = "digest string, first struct<last: boolean, id: bigint, locator: string>, n bigint, batch int"


def normalised(text: Column) -> Column:
    """Each run of space, tab, line feed, vertical tab, form feed and carriage return is one space."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def keyed_state(arrivals: DataFrame) -> DataFrame:
    """The state of a stream of (id, digest, locator) rows: one entry per digest."""
    return arrivals.groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "locator")).alias("first"),
        F.count(F.lit(1)).alias("n"),
    )


def update_state(spark: SparkSession, arrivals: str, schema, checkpoint: str, out: str) -> None:
    """Feed the files of ``arrivals`` not seen yet to the state kept in ``checkpoint``.

    Changed entries of each batch are written to ``out/batch=<n>``; a batch that runs again
    overwrites its own folder. Calling this again, with more files, continues with the same state.
    """
    session = spark.newSession()  # the settings stay out of the caller's session
    for key, value in _STATE_SETTINGS.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = keyed_state(session.readStream.schema(schema).parquet(arrivals))
    (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
        .awaitTermination()
    )


def read_state(spark: SparkSession, out: str) -> DataFrame:
    """digest, keep_id, locator, n: the newest entry of every digest."""
    entries = spark.read.schema(_ENTRY).parquet(out)
    newest = entries.groupBy("digest").agg(F.max_by(F.struct("first", "n"), "batch").alias("s"))
    return newest.select(
        "digest", F.col("s.first.id").alias("keep_id"), F.col("s.first.locator").alias("locator"), F.col("s.n").alias("n"))


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), normalised(F.col("text")).alias("t"))


def exact_copies(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest`` maps the normalised text to the key of the state; any function gives the same
    groups, a weak one only makes more hits that turn out to differ.
    """
    spark = docs.sparkSession
    arrivals, state, checkpoint = (block_path(spark, name) for name in ("arrivals", "state", "checkpoint"))
    texts_of(docs).select(
        "id", digest(F.col("t")).cast("string").alias("digest"), sha256(F.col("t")).alias("sha"),
        F.input_file_name().alias("locator"),
    ).write.parquet(arrivals)
    rows = spark.read.parquet(arrivals)
    update_state(spark, arrivals, rows.schema, checkpoint, state)
    found = stage(rows.drop("locator").join(read_state(spark, state), "digest"), "found")
    odd = stage(_differing(docs, found.where(F.col("n") > 1), digest), "differing")

    lost = odd.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
    marks = odd.select(*(F.col(c).alias(f"_{c}") for c in ("id", "digest", "sha"))).distinct()
    good = (
        found.join(marks, (found["digest"] == marks["_digest"]) & (found["sha"] == marks["_sha"])
                   & found["id"].eqNullSafe(marks["_id"]), "left_anti")
        .join(lost, "digest", "left")
        .select("id", "sha", "keep_id", (F.col("n") - F.coalesce("lost", F.lit(0))).alias("n"))
    )
    group = Window.partitionBy("digest", "t")
    rest = odd.select("id", "sha", F.min("id").over(group).alias("keep_id"), F.count(F.lit(1)).over(group).alias("n"))
    again = F.row_number().over(Window.partitionBy("id", "sha").orderBy("keep_id"))
    return good.unionByName(rest).select(
        F.col("id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & (again == 1)).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def _differing(docs: DataFrame, hits: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Rows (id, digest, sha, t) of ``hits`` whose full bytes are not those of the row that stays.

    Only texts of rows with copies are read. The text that stays is handed out once per SALT_ROWS
    rows of its group, so a group of any size is many small meetings.
    """
    members = stage(hits.select(F.col("id").alias("_id")).distinct(), "members")
    texts = texts_of(docs).join(broadcast_if_small(members), F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    texts = stage(texts.withColumn("digest", digest(F.col("t")).cast("string")), "hit_texts")
    groups = hits.select("digest", "keep_id", F.ceil(F.col("n") / SALT_ROWS).cast("int").alias("salts")).distinct()
    met = texts.join(groups, "digest").withColumn("salt", F.pmod(F.xxhash64("id", F.length("t")), "salts").cast("int"))
    kept = (
        met.where(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("digest", "salts").agg(F.min("t").alias("kept"))
        .select("digest", "kept", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    )
    return met.join(kept, ["digest", "salt"]).where(F.col("t") != F.col("kept")).select(
        "id", "digest", sha256(F.col("t")).alias("sha"), "t")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns and texts as they were."""
    names = docs.columns
    id_, sha = unused("_id", docs), unused("_sha", docs)
    result = stage(exact_copies(docs), "copies")
    classes = result.groupBy(F.col("doc_id").alias(id_), F.col("text_sha256").alias(sha)).agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    classes = stage(classes.where(~F.col("kept") | (F.col("rows") > 1)), "not_single")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(id_)) & (sha256(normalised(docs["text"])) == F.col(sha))
    single = docs.join(broadcast_if_small(classes.select(id_, sha)), same, "left_anti")
    repeated = classes.where("kept").select(id_, sha)
    if not repeated.limit(1).count():
        return single
    ones = docs.join(broadcast_if_small(repeated), same).dropDuplicates([id_, sha]).select(*names)
    return single.unionByName(ones)
