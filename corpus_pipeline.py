"""From raw documents to encoded training rows: five stages, each written and read by the next.

quality      rows that the classifier rejects go
exact_dedup  of equal texts the row with the smallest doc_id stays
near_dedup   of each group of near copies (similarity 0.8 or more) the row with the smallest doc_id stays
mix          words are mixed to the target weights of their sources; a row is a run of words taken
encode       adds ``ids``, the SentencePiece ids of the text

All stages but the last return the columns of ``documents``. The classifier learns from the labels
of the same folder, from rows that are not held out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import exact_dedup, mixing, near_dedup, pieces, quality, queries
from textmill.workspace import keep, staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
NEAR_PERCENT = 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_rejected(docs, queries.quality_model(docs, sf_dir))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, pieces.load(queries.tokenizer_path(queries.PIECES)))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("mix", mix_sources),
    ("encode", encode_pieces),
]

# A classifier, hashed draws and Viterbi have no SQL form: the stages are tested against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        with staging(spark):  # what a stage writes on its way goes when its result is written
            docs = keep(step(spark, docs, sf_dir), name)
    return docs
