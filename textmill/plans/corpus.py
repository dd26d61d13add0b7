"""Whole corpus builds: many inputs to one JSON-lines corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import char_length, clean_text, parse_size, row_bytes
from ..operators.convert import convert
from ..operators.dedupe import digest, mark_repeats
from ..operators.order import block_sequence, first_docs, mix_sources, prefix_end
from ..operators.report import KEPT, REPEAT, SHORT, corpus_report
from ..operators.sinks import file_of, in_files, write_corpus
from ..sources.files import ORDER, read_corpus, wiki_shards
from ..workspace import joined_by_task, keep, stage, stage_by_task, staging

BLOCK = ORDER[:-1]


def write_chosen(texts: DataFrame, chosen: DataFrame, path: str) -> None:
    """Write the ``text`` of the rows of ``chosen`` (task, row, at, row_bytes) by ``at``.

    ``texts`` are staged by task. The join leaves them in place; they cross the network once, to
    the file that their place in bytes belongs to.
    """
    placed, files = file_of(chosen, "at", "row_bytes")
    with joined_by_task(texts.sparkSession):
        rows = texts.select("task", "row", "text").join(placed.select("task", "row", "at", "file"), ["task", "row"])
        write_corpus(in_files(rows, "file", files, ["at"]), path, [])


def prepare(raw: DataFrame, dictionary=None) -> DataFrame:
    """Clean and convert ``raw`` into ``text``; everything later steps ask about is a narrow column."""
    texts = convert(raw.withColumn("text", clean_text(F.col("raw"))).drop("raw"), "text", dictionary)
    return texts.withColumns({
        "n_chars": char_length(F.col("text")),
        "row_bytes": row_bytes(F.col("text")),
        "digest": digest(F.col("text")),
    })


def decide(
    prepared: DataFrame, order: str, min_chars: int = 80, dedupe: bool = False, max_bytes: int = 0
) -> DataFrame:
    """``order, status, row_bytes`` of every record that is read before the byte budget ends.

    Works on narrow columns only. Short texts are set aside before repeats are looked for, and
    repeats before bytes are counted.
    """
    facts = prepared.select(order, "n_chars", "row_bytes", "digest")
    short = facts.where(F.col("n_chars") < min_chars).select(order, F.lit(SHORT).alias("status"), "row_bytes")
    long = facts.where(F.col("n_chars") >= min_chars)
    if dedupe:
        long = mark_repeats(long, F.col("digest"), order)
        kind = F.when(F.col("repeated"), REPEAT).otherwise(KEPT)
    else:
        kind = F.lit(KEPT)
    status = stage(short.unionByName(long.select(order, kind.alias("status"), "row_bytes")), "status")
    if max_bytes <= 0:
        return status
    end = prefix_end(status.where(F.col("status") == KEPT), order, "row_bytes", max_bytes).scalar()
    return status.where(F.coalesce(F.col(order) < end, F.lit(True)))


def build_corpus(
    spark: SparkSession,
    inputs: list[str],
    out_path: str,
    min_chars: int = 80,
    max_bytes: str | int = "",
    dictionary: DataFrame | dict[str, str] | None = None,
    dedupe: bool = False,
    mix: bool = False,
    seed: int = 42,
) -> DataFrame:
    """Read, clean, convert, filter, deduplicate, mix and cap the inputs, write the corpus and
    return the report.

    The inputs are read and cleaned once and written with their order key. All decisions are
    taken on the narrow columns of that table; the texts are read again only for the output, where
    they meet the decisions and go to their place.
    """
    with staging(spark):
        prepared = stage_by_task(prepare(read_corpus(spark, inputs), dictionary), "prepared")
        narrow = block_sequence(prepared.drop("text"), BLOCK, "pos")
        facts = narrow.select("seq", "src_ord", "n_chars", "row_bytes", "digest")
        order = "seq"
        if mix:
            facts = stage(mix_sources(facts, "src_ord", "seq", seed), "mixed")
            order = "place"
        status = stage(decide(facts.withColumnRenamed(order, "at"), "at", min_chars, dedupe, parse_size(max_bytes)), "decided")
        kept = status.where(F.col("status") == KEPT).select("at")
        if mix:
            kept = kept.join(facts.select(F.col(order).alias("at"), "seq"), "at")
        else:
            kept = kept.withColumn("seq", F.col("at"))
        chosen = stage(narrow.join(kept, "seq").select("task", "row", "at", "row_bytes"), "chosen")
        write_chosen(prepared, chosen, out_path)
        return keep(corpus_report(status), "report")


def prepare_wiki(
    spark: SparkSession,
    input_dir: str,
    out_path: str,
    min_chars: int = 80,
    max_docs: int = 0,
    dictionary: DataFrame | dict[str, str] | None = None,
) -> DataFrame:
    """Clean the ``wiki_*`` shards under a folder into a corpus; returns the number of documents."""
    with staging(spark):
        raw = wiki_shards(spark, input_dir)
        texts = convert(raw.withColumn("text", clean_text(F.col("raw"))).drop("raw"), "text", dictionary)
        kept = texts.where(char_length(F.col("text")) >= min_chars).withColumn("row_bytes", row_bytes(F.col("text")))
        kept = stage_by_task(kept, "wiki")
        numbered = block_sequence(kept.select(*BLOCK, "pos", "task", "row", "row_bytes"), BLOCK, "pos", "at")
        chosen = stage(first_docs(numbered, "at", max_docs).select("task", "row", "at", "row_bytes"), "chosen")
        write_chosen(kept, chosen, out_path)
        return keep(chosen.agg(F.count("*").alias("saved")), "report")
