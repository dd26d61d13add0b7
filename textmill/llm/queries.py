"""The queries of this package over whole tables, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, exact_dedup, line_dedup, mixing, near_dedup, periodic, pieces, quality, repeats, surrogates, token_counts, topk, whitening

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# Files of public tokenizers; another vocabulary is another path.
PIECES = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"
MULTI_BPE = "byte_bpe_multi_50k.tiktoken"


# The key of the surrogates; a real one comes from a secret store.
SURROGATE_KEY = "textmill"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query()
def op1_line_dedup(spark, sf_dir):
    return line_dedup.without_common_blocks(documents(spark, sf_dir)).drop("kept")


@query()
def op2_pieces(spark, sf_dir):
    return pieces.round_trips(documents(spark, sf_dir), pieces.load(tokenizer_path(PIECES)))


@query()
def op3_mix_sources(spark, sf_dir):
    return mixing.taken_words(documents(spark, sf_dir))


@query(r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
""")
def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_copies(documents(spark, sf_dir))


def quality_model(docs: DataFrame, sf_dir: str) -> quality.Model:
    labels = docs.sparkSession.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.fit(docs, labels, ~quality.held_out(F.col("_id")))


@query()
def op8_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    scored = quality.score(docs, quality_model(docs, sf_dir))
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.KEEP_SCORE).cast("int").alias("predicted"))


@query()
def op7_near_dedup(spark, sf_dir):
    return near_dedup.near_copies(documents(spark, sf_dir))


@query("""
WITH v AS (
  SELECT row_number() OVER () r, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.r, q.vec_id query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.r <> q.r AND len(q.e) = len(c.e)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""")
def op5_top_k(spark, sf_dir):
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


@query()
def op10_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir), token_counts.load(tokenizer_path(BYTE_BPE)))


@query()
def op4_repeats(spark, sf_dir):
    return repeats.without_repeats(documents(spark, sf_dir)).drop("kept")


@query()
def op9_surrogates(spark, sf_dir):
    return surrogates.pseudonymised(documents(spark, sf_dir), SURROGATE_KEY)


@query()
def op11_byte_bpe(spark, sf_dir):
    import public_tokenizers

    ranks = byte_bpe.load(tokenizer_path(MULTI_BPE))
    rows = byte_bpe.decode(byte_bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN), ranks)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.translate(F.to_json("ids"), "[]", "").cast("binary"), 256).alias("ids_sha256"),  # a string each would be much garbage
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op12_whitening(spark, sf_dir):
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query()
def op13_periodic_runs(spark, sf_dir):
    found = periodic.periodic_runs(periodic.with_planted_run(documents(spark, sf_dir)))
    found = found.withColumn("best", periodic.strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
