"""Mixing sources to target weights, by blocks of words that are drawn for output shards.

The words of a source, document after document, are packed into blocks of a fixed length (the last
may be shorter). Every output shard has a fixed number of slots and draws multinomial counts of
blocks per source, one weighted draw per slot. What a source draws over its quota is drawn
anew from the sources that are still short, so totals meet the targets. The n-th slot of a source
takes block ``permutation(n)`` of it: the index is permuted pseudorandomly (swap-or-not), so no block
comes a second time before all came once. Slots and blocks are joined by (source, block index), by a
shuffle at any size.

Targets: sources in code point order, null last, weigh 5, 2, 1, 5, 2, 1, ... and share 150 % of all
words; none gets more than twice its own words, and what is cut off goes to the others by weight.

Defined results. A null text has no words. A null source is a source. Documents without words take
no part and are reported with 0. Rows that repeat are rows of their own. Reruns on the same rows give
the same mix. Only doc_id, source and text are read. A source may hold any share of all rows: running
totals are taken over small ranges of ids, and draws are spread over slots, not sources.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.order import running_total
from ..workspace import broadcast_if_small, stage
from .sizes import unused

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_PASSES = 2
BLOCK_WORDS = 64
SHARD_SLOTS = 65_536
RANGE_SLOTS = 4_096  # slots made from one row
TASK_SLOTS = 131_072  # slots made by one task, on average
PERMUTATION_ROUNDS = 8
WORD = r"[^\x20\x09-\x0D]+"


@dataclass
class Mix:
    """rows (_row, doc_id, source, size), sources (source, s, source_size, target, blocks, quota),
    pieces (_row, s, block, start, words) and slots (s, shard, nth, epoch, block)."""

    rows: DataFrame
    sources: DataFrame
    pieces: DataFrame
    slots: DataFrame


def by_shuffle(df: DataFrame) -> DataFrame:
    """The next join shuffles both of its sides, whatever size Spark expects of them.

    It takes rows made by ``explode`` for no more than those they are made from, and a table for its packed bytes;
    what it then broadcasts goes through the driver.
    """
    return df.hint("merge")


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = MOST_PASSES) -> DataFrame:
    """Add s (rank from 1), weight and target to (source, source_size), one row per source.

    The target is ``min(passes * size, level * weight)``. Taken in the order of passes * size /
    weight, the capped sources come first; the level is what the others share per unit of weight.
    """
    ranked = sizes.withColumn("s", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("s") - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size") * passes
    rows = ranked.withColumn("weight", weight.cast("double")).withColumn("cap", cap.cast("double"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", "s").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    left = F.sum("source_size").over(all_rows) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    shared = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / shared)
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "s", "level"))).over(all_rows)["level"]
    return rows.withColumn("target", F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))).select(
        "source", "s", "source_size", "weight", "target")


def permuted(index: Column, size: Column, key: list[Column], seed: int) -> Column:
    """The place of ``index`` in a pseudorandom permutation of [0, size), another one for each key.

    Swap-or-not: each round pairs x with k - x and lets a hash of the pair say whether they change
    places, which is a permutation for any size.
    """

    def swap_or_not(x: Column, r: Column) -> Column:
        other = F.pmod(F.xxhash64(F.lit(seed), r, *key) - x, size)
        swap = F.xxhash64(F.lit(seed), r, F.greatest(x, other), *key).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(PERMUTATION_ROUNDS)), index, swap_or_not)


def shard_counts(sources: DataFrame, slots: int, seed: int, shard_slots: int) -> DataFrame:
    """(shard, s, n): how many blocks of each source every shard takes; sums over shards are quotas.

    A draw finds its source through an equi-join: [0, 1) is cut into cells, a source lies in the
    cells that its interval of the cumulative weights touches.
    """
    spark = sources.sparkSession
    cells = 4 * max(1, sources.count())
    below = F.coalesce(F.sum("quota").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sources.select("s", (below / slots).alias("lo"), ((below + F.col("quota")) / slots).alias("hi")).where("hi > lo")
    last = F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1))
    parts = parts.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * cells), last)))
    drawn = spark.range(slots).select(
        F.col("id").alias("slot"), F.floor(F.col("id") / shard_slots).alias("shard"),
        (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 11) / float(1 << 53)).alias("u"))
    drawn = drawn.withColumn("cell", F.floor(F.col("u") * cells)).join(parts, "cell")
    counts = drawn.where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi"))).groupBy("shard", "s").agg(
        F.count(F.lit(1)).alias("n"))
    counts = stage(counts, "draws")

    # What a source drew over its quota goes, slot by slot, to the sources that are short of theirs.
    earlier = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    room = F.greatest(F.col("quota") - F.coalesce(F.sum("n").over(earlier), F.lit(0)), F.lit(0))
    within = counts.join(sources.select("s", "quota"), "s").withColumn("got", F.least("n", room))
    within = stage(within.select("shard", "s", "got", (F.col("n") - F.col("got")).alias("over")), "within")
    numbered = F.coalesce(F.sum("free").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def one_each(rows: DataFrame, name: str) -> DataFrame:
        rows = rows.where("free > 0").withColumn("first", numbered)
        return rows.select(F.col("k").alias(name), F.explode(F.sequence("first", F.col("first") + F.col("free") - 1)).alias("x"))

    free = one_each(within.groupBy(F.col("shard").alias("k")).agg(F.sum("over").alias("free")), "shard")
    got = within.groupBy("s").agg(F.sum("got").alias("had"))
    short = sources.join(got, "s", "left").select(
        F.col("s").alias("k"), (F.col("quota") - F.coalesce("had", F.lit(0))).alias("free"))
    anew = by_shuffle(free).join(one_each(short, "s"), "x").groupBy("shard", "s").agg(F.count(F.lit(1)).alias("got"))
    return within.select("shard", "s", "got").unionByName(anew).groupBy("shard", "s").agg(F.sum("got").alias("n")).where("n > 0")


def mix(docs: DataFrame, *, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 42,
        key: str | None = None) -> Mix:
    """``key`` names a unique long column that identifies a row; without it rows are numbered."""
    row = F.col(key) if key else F.monotonically_increasing_id()
    rows = stage(docs.select(
        row.alias("_row"), F.col("doc_id"), F.col("source").cast("string").alias("source"),
        words_in(F.col("text")).alias("size")), "sizes")
    sources = stage(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    blocks = F.ceil(F.col("source_size") / block_words)
    quota = F.when(F.col("source_size") > 0, F.least(
        F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"), F.col("blocks") * MOST_PASSES))
    sources = stage(sources.withColumn("blocks", blocks).withColumn("quota", F.coalesce(quota, F.lit(0))), "quotas")

    # Where each document's words lie among those of its source; ranges hold few rows of any source.
    width = max(256, math.isqrt(rows.count()))
    names = sources.select(F.col("source").alias("_source"), "s")
    keyed = rows.where("size > 0").join(broadcast_if_small(names), F.col("source").eqNullSafe(F.col("_source")))
    at = F.coalesce(F.col("doc_id").cast("long"), F.col("_row"))
    placed = running_total(keyed, F.col("size"), "end", [F.floor(at / width)], [at, F.col("_row")], ["s"])
    placed = placed.withColumn("begin", F.col("end") - F.col("size"))
    block = F.explode(F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words)))
    pieces = placed.withColumn("block", block)
    lo, hi = F.greatest("begin", F.col("block") * block_words), F.least("end", (F.col("block") + 1) * block_words)
    pieces = pieces.select("_row", "s", "block", (lo - F.col("begin")).alias("start"), (hi - lo).alias("words"))

    slots = int(sources.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0])
    counts = shard_counts(sources, slots, seed, shard_slots) if slots else docs.sparkSession.createDataFrame([], "shard long, s int, n long")
    earlier = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(sources.select("s", "blocks"), "s")
    end = F.col("first") + F.col("n") - 1
    ranges = runs.select("s", "shard", "blocks", end.alias("end"), F.explode(F.sequence("first", end, F.lit(RANGE_SLOTS))).alias("at"))
    # A number of its own: by their bytes these few rows would all be one task's, which then makes every slot.
    ranges = ranges.repartition(max(1, -(-slots // TASK_SLOTS)), "s", "at")
    nth = ranges.select("s", "shard", "blocks", F.explode(F.sequence("at", F.least("end", F.col("at") + RANGE_SLOTS - 1))).alias("nth"))
    taken = nth.withColumn("epoch", F.floor(F.col("nth") / F.col("blocks"))).withColumn("block", F.pmod("nth", "blocks"))
    block = permuted(F.col("block"), F.col("blocks"), [F.col("s"), F.col("epoch")], seed)
    return Mix(rows, sources, pieces, taken.withColumn("block", block))


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken."""
    m = mix(docs, **options)
    times = m.slots.groupBy("s", "block").agg(F.count(F.lit(1)).alias("times"))
    words = by_shuffle(m.pieces).join(times, ["s", "block"]).groupBy("_row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    sources = m.sources.select(F.col("source").alias("_source"), "source_size", "target")
    return (
        m.rows.join(words, "_row", "left")
        .join(broadcast_if_small(sources), F.col("source").eqNullSafe(F.col("_source")))
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows with the columns of ``docs``: for each pass over a source, every run of words taken
    from a document is a row with its text (n_chars, if there, is its length).

    A document that is taken whole keeps its text as it is.
    """
    ids = docs.select(F.col("doc_id").alias("k"))
    key = unused("_key", docs)
    keyed = docs.withColumn(key, F.col("doc_id").cast("long"))
    if ids.where("k IS NULL").limit(1).count() or ids.groupBy("k").count().where("count > 1").limit(1).count():
        keyed = stage(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
    m = mix(keyed, key=key, **options)
    passes = m.slots.select("s", "block", "epoch").distinct()
    parts = by_shuffle(m.pieces).join(passes, ["s", "block"]).select("_row", "epoch", "start", (F.col("start") + F.col("words")).alias("end"))
    order = Window.partitionBy("_row", "epoch").orderBy("start")
    fresh = F.coalesce((F.lag("end").over(order) != F.col("start")).cast("int"), F.lit(1))
    runs = parts.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order))
    runs = runs.groupBy("_row", "epoch", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = by_shuffle(runs).join(m.rows.select("_row", "size"), "_row")
    runs = runs.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("epoch", "start", "end", "size"))).alias("runs"))

    run = F.col("run")
    words = F.regexp_extract_all(F.col("row.text").cast("string"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0)
    some = F.array_join(F.slice(words, (run["start"] + 1).cast("int"), (run["end"] - run["start"]).cast("int")), "")
    some = F.when(run["start"] > 0, F.regexp_replace(some, r"^[\x20\x09-\x0D]+", "")).otherwise(some)
    text = F.when((run["start"] == 0) & (run["end"] == run["size"]), F.col("row.text")).otherwise(some)
    rows = keyed.select(F.col(key).alias("_row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = by_shuffle(rows).join(runs, "_row").select("row", F.explode("runs").alias("run")).select("row", text.alias("new"))
    new = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("new").cast(docs.schema["n_chars"].dataType)
    return rows.select(*(new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns))
