"""One query per operator over the given tables, with the SQL that must give the same rows.

Arrays are shown as comma-separated text so that any engine compares them alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import fixtures as fx
from .functions import chat as C
from .functions import text as X
from .operators import convert, dedupe, encode, feed, order, report, sinks, vocab
from .plans import corpus, training
from .sources import files, samples
from .workspace import fresh_path, spread, stage

MIN_CHARS = 80
BUDGET = "1MB"
SEED = 42
LENGTH = 64
CHAT_LENGTH = 256
RANKS = 3
EPOCHS = 2
BATCH = 16
VOCAB_SIZE = 300

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "documents")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "conversations")


def shown(ids: Column) -> Column:
    return F.array_join(ids, ",")


# --- pieces of SQL -------------------------------------------------------------------------------

WS = "'" + X.SPACES + "'"


def sql_strip(text: str) -> str:
    return f"trim({text}, {WS})"


def sql_clean(text: str) -> str:
    lines = f"string_split(replace(replace({text}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))"
    return f"array_to_string([trim(x, {WS}) FOR x IN {lines} IF trim(x, {WS}) <> ''], chr(10))"


def sql_bytes(text: str) -> str:
    return f"(octet_length(encode(CAST(to_json({{'text': {text}}}) AS VARCHAR))) + 2)"


CLEANED = f"cleaned AS (SELECT doc_id, source, {sql_clean('text')} AS t FROM documents)"

# Status of every document: short texts first, then repeats of an earlier long one.
STATUS = f"""{CLEANED}, status AS (
  SELECT doc_id, source, t, {sql_bytes('t')} AS b,
    CASE WHEN length(t) < {MIN_CHARS} THEN 'short'
         WHEN row_number() OVER (PARTITION BY t ORDER BY doc_id) > 1 THEN 'repeat' ELSE 'kept' END AS s
  FROM cleaned)"""

# ... and whether the byte budget is still open when it is read.
CAPPED = f"""{STATUS}, running AS (
  SELECT *, sum(CASE WHEN s = 'kept' THEN b ELSE 0 END) OVER (ORDER BY doc_id) AS total FROM status),
capped AS (SELECT * FROM running
  WHERE doc_id < coalesce((SELECT min(doc_id) FROM running WHERE s = 'kept' AND total > {X.parse_size(BUDGET)}), 9e18))"""

COUNTERS = """count(*) FILTER (WHERE s = 'kept') AS saved, count(*) FILTER (WHERE s = 'short') AS skipped,
  count(*) FILTER (WHERE s = 'repeat') AS duplicated,
  CAST(coalesce(sum(b) FILTER (WHERE s = 'kept'), 0) AS BIGINT) AS written_bytes,
  round(coalesce(sum(b) FILTER (WHERE s = 'kept'), 0) / 1073741824.0, 2) AS size_gb"""


# --- cleaning, filters, dedupe, limits -------------------------------------------------------------

NOISY_SQL = """CASE doc_id % 4 WHEN 0 THEN replace(text, chr(10), chr(13) || chr(10))
  WHEN 1 THEN chr(160) || replace(text, chr(10), ' ' || chr(12288) || chr(13) || chr(9)) || chr(13)
  WHEN 2 THEN chr(10) || chr(28) || replace(text, ' ', chr(8195) || chr(10) || ' ') ELSE text END"""


@query(f"SELECT doc_id, {sql_clean(f'({NOISY_SQL})')} AS text FROM documents")
def clean_text(spark, sf_dir):
    text, kind = F.col("text"), F.col("doc_id") % 4
    noisy = (
        F.when(kind == 0, F.replace(text, F.lit("\n"), F.lit("\r\n")))
        .when(kind == 1, F.concat(F.lit("\xa0"), F.replace(text, F.lit("\n"), F.lit(" 　\r\t")), F.lit("\r")))
        .when(kind == 2, F.concat(F.lit("\n\x1c"), F.replace(text, F.lit(" "), F.lit(" \n "))))
        .otherwise(text)
    )
    return documents(spark, sf_dir).select("doc_id", X.clean_text(noisy).alias("text"))


@query(f"WITH {CLEANED} SELECT doc_id, length(t) AS n_chars FROM cleaned WHERE length(t) >= {MIN_CHARS}")
def min_chars(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", X.char_length(X.clean_text(F.col("text"))).alias("n_chars"))
    return rows.where(F.col("n_chars") >= MIN_CHARS)


def prepared_documents(spark, sf_dir) -> DataFrame:
    """Cleaned documents with their narrow facts."""
    raw = documents(spark, sf_dir).select("doc_id", "source", F.col("text").alias("raw"))
    return corpus.prepare(raw)


@query(f"WITH {STATUS} SELECT doc_id, t AS text FROM status WHERE s = 'kept'")
def dedupe_first(spark, sf_dir):
    long = prepared_documents(spark, sf_dir).where(F.col("n_chars") >= MIN_CHARS)
    return dedupe.dedupe_first(long, "text", "doc_id").select("doc_id", "text")


def document_status(spark, sf_dir, budget: str = "") -> DataFrame:
    rows = stage(prepared_documents(spark, sf_dir).drop("text"), "documents")
    status = corpus.decide(rows, "doc_id", MIN_CHARS, True, X.parse_size(budget))
    return status.join(rows.select("doc_id", "source"), "doc_id")


@query(f"WITH {STATUS} SELECT source, {COUNTERS} FROM status GROUP BY source")
def build_report(spark, sf_dir):
    return report.corpus_report(document_status(spark, sf_dir), ("source",))


@query(f"WITH {CAPPED} SELECT {COUNTERS} FROM capped")
def capped_report(spark, sf_dir):
    return report.corpus_report(document_status(spark, sf_dir, BUDGET))


@query(f"WITH {CLEANED} SELECT doc_id, {sql_bytes('t')} AS row_bytes FROM cleaned")
def row_bytes(spark, sf_dir):
    return prepared_documents(spark, sf_dir).select("doc_id", "row_bytes")


@query(f"""WITH {CLEANED}, running AS (SELECT doc_id, {sql_bytes('t')} AS row_bytes,
  sum({sql_bytes('t')}) OVER (ORDER BY doc_id) AS total FROM cleaned)
SELECT doc_id, row_bytes FROM running WHERE total <= {X.parse_size(BUDGET)}""")
def byte_budget(spark, sf_dir):
    rows = prepared_documents(spark, sf_dir)
    kept = order.byte_budget(rows, "doc_id", F.col("row_bytes"), X.parse_size(BUDGET))
    return kept.select("doc_id", "row_bytes")


@query(f"""WITH {CLEANED} SELECT doc_id, t AS text FROM cleaned WHERE length(t) >= {MIN_CHARS}
ORDER BY doc_id LIMIT 150""")
def max_docs(spark, sf_dir):
    rows = prepared_documents(spark, sf_dir).where(F.col("n_chars") >= MIN_CHARS)
    return order.first_docs(rows, "doc_id", 150).select("doc_id", "text")


@query("""SELECT doc_id, CAST(CASE doc_id % 6 WHEN 0 THEN n_chars WHEN 1 THEN n_chars * 1024
  WHEN 2 THEN n_chars * 1048576 WHEN 3 THEN trunc((n_chars + 0.5) * 1073741824) WHEN 4 THEN 0
  ELSE trunc(n_chars / 10.0 * 1024) END AS BIGINT) AS bytes FROM documents""")
def parse_bytes(spark, sf_dir):
    n, kind = F.col("n_chars").cast("string"), F.col("doc_id") % 6
    size = (
        F.when(kind == 0, n).when(kind == 1, F.concat(F.lit(" "), n, F.lit("kb ")))
        .when(kind == 2, F.concat(n, F.lit(" M"))).when(kind == 3, F.concat(n, F.lit(".5Gb")))
        .when(kind == 4, "").otherwise(F.concat((F.col("n_chars") / 10).cast("string"), F.lit("K")))
    )
    return documents(spark, sf_dir).select("doc_id", X.size_bytes(size).alias("bytes"))


# --- records -------------------------------------------------------------------------------------

MIXED = f"""mixed AS (SELECT doc_id, {fx.MIXED_SQL.format(t=sql_strip('text'), n='doc_id')} AS raw FROM documents)"""


@query(f"""WITH {MIXED} SELECT doc_id, {sql_clean(f"CASE doc_id % 8 WHEN 5 THEN {sql_strip('text')} ELSE coalesce(raw, {sql_strip('text')}) END")} AS text
FROM mixed JOIN documents USING (doc_id)""")
def extract_text(spark, sf_dir):
    """Records of every shape; where the mixed shape is malformed or holds no text, one with the text behind an empty field."""
    rows, kind = documents(spark, sf_dir), F.col("doc_id") % 8
    behind = F.to_json(F.struct(F.lit("").alias("text"), F.col("text").alias("content")))
    record = F.parse_json(F.when(kind.isin(5, 6), behind).otherwise(fx.mixed_record(F.col("text"), F.col("doc_id"))))
    parsed = rows.select("doc_id", record.alias("record"))
    return parsed.select("doc_id", X.clean_text(X.record_text(F.col("record"))).alias("text"))


@query("""SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN '' WHEN 1 THEN 'None' WHEN 2 THEN 'True' WHEN 3 THEN 'False'
  WHEN 4 THEN CAST(n_chars AS VARCHAR) WHEN 5 THEN n_chars || '.0' WHEN 6 THEN n_chars || '.25'
  WHEN 7 THEN '-' || n_chars || '0000000.0' ELSE text END AS value, text AS content FROM documents""")
def record_value(spark, sf_dir):
    n, kind = F.col("n_chars").cast("string"), F.col("doc_id") % 9

    beside = F.expr("substring(to_json(named_struct('content', text)), 2)")

    def holding(value):
        return F.concat(F.lit('{"text": '), value, F.lit(", "), beside)

    line = (
        F.when(kind == 0, F.concat(F.lit('{"other": 1, '), beside)).when(kind == 1, holding(F.lit("null")))
        .when(kind == 2, holding(F.lit("true"))).when(kind == 3, holding(F.lit("false")))
        .when(kind == 4, holding(n)).when(kind == 5, holding(F.concat(n, F.lit(".0"))))
        .when(kind == 6, holding(F.concat(n, F.lit(".250")))).when(kind == 7, holding(F.concat(F.lit("-"), n, F.lit("e7"))))
        .otherwise(F.to_json(F.struct("text", F.col("text").alias("content"))))
    )
    parsed = documents(spark, sf_dir).select("doc_id", F.parse_json(line).alias("record"))
    return parsed.select("doc_id", *(X.python_str(X.variant_field(F.col("record"), name)).alias(alias) for name, alias in (("text", "value"), ("content", "content"))))


# --- sources ---------------------------------------------------------------------------------------

def placed(source: DataFrame, keys: list[str]) -> DataFrame:
    """``place, text``: cleaned records numbered in reading order."""
    rows = order.block_sequence(stage(source, "records"), keys, "pos").select("seq", "raw")
    numbered = order.position(rows, "place", [F.shiftright("seq", 16)], [F.col("seq")])
    return numbered.select("place", X.clean_text(F.col("raw")).alias("text"))


ONE_INPUT = ["file_class", "file_parts", "blk"]


@query(f"""WITH {MIXED} SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, {sql_clean('raw')} AS text
FROM mixed WHERE raw IS NOT NULL""")
def json_lines(spark, sf_dir):
    path = fresh_path(spark, "mixed.jsonl")
    fx.jsonl_folder(documents(spark, sf_dir), path, fx.mixed_record(F.col("text"), F.col("doc_id")), "doc_id")
    return placed(files.json_lines(spark, path), ONE_INPUT)


@query(f"SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, {sql_clean('text')} AS text FROM documents")
def json_envelope(spark, sf_dir):
    folder = fresh_path(spark, "envelopes")
    fx.json_files(documents(spark, sf_dir), folder, "text", "doc_id")
    return placed(files.json_file(spark, folder, "*.json"), ONE_INPUT)


@query(f"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS place, {sql_strip('line')} AS text FROM lines""")
def text_lines(spark, sf_dir):
    folder = fresh_path(spark, "lines")
    fx.named_lines(documents(spark, sf_dir), folder, F.col("text"), "doc_id", "docs", ".txt")
    return placed(files.text_lines(spark, folder, "*.txt"), ONE_INPUT)


@query(f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place,
  {sql_clean("CASE doc_id % 3 WHEN 1 THEN lang || chr(10) || text ELSE text END")} AS text FROM documents""")
def parquet_rows(spark, sf_dir):
    folder = fresh_path(spark, "tables")
    kind = F.col("doc_id") % 3
    documents(spark, sf_dir).orderBy("doc_id").select(
        F.col("doc_id").alias("title"),  # not a string: never taken
        F.when(kind == 0, F.col("text")).alias("content"),
        F.when(kind != 0, F.col("text")).alias("output"),
        F.when(kind == 1, F.col("lang")).otherwise(" ").alias("instruction"),
    ).write.parquet(folder)
    return placed(files.parquet_rows(spark, folder, "*.parquet"), ONE_INPUT)


@query(f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, {sql_clean("""
  CASE doc_id % 10 WHEN 1 THEN CAST(length(text) AS VARCHAR) || '.0' WHEN 2 THEN 'None' WHEN 3 THEN '' WHEN 4 THEN 'True' ELSE text END
""")} AS text FROM documents""")
def strict_lines(spark, sf_dir):
    """Objects of every shape: numbers, null, no text, a repeated key, NaN beside the text."""
    path, kind, text = fresh_path(spark, "strict.jsonl"), F.col("doc_id") % 10, F.to_json(F.struct("text"))
    line = (
        F.when(kind == 1, F.concat(F.lit('{"text": '), F.char_length("text").cast("string"), F.lit(".0}")))
        .when(kind == 2, '{"text": null}').when(kind == 3, '{"other": 1}').when(kind == 4, '{"text": true}')
        .when(kind == 5, F.concat(F.lit('{"text": "unused", '), F.substr(text, F.lit(2))))
        .when(kind == 6, F.concat(F.lit('{"v": NaN, '), F.substr(text, F.lit(2)))).otherwise(text)
    )
    fx.jsonl_folder(documents(spark, sf_dir), path, line, "doc_id")
    return placed(files.strict_json_lines(spark, path), ONE_INPUT)


@query("""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, CASE doc_id % 4
  WHEN 0 THEN '{''n'': ' || n_chars || ', ''lang'': ''' || lang || ''', ''ok'': [True, None, -0.0]}'
  WHEN 1 THEN '[' || n_chars || ', [''' || source || '''], {}]' WHEN 2 THEN '-0.0' ELSE '0.0' END AS text FROM documents""")
def strict_nested(spark, sf_dir):
    """Nested values and negative zeros; every third line has a NaN beside the text, which another parser reads."""
    path, kind = fresh_path(spark, "nested.jsonl"), F.col("doc_id") % 4
    nested = F.concat(F.lit('{"n":'), F.col("n_chars").cast("string"), F.lit(', "lang": "'), F.col("lang"), F.lit('", "ok":[true,null, -0.0]}'))
    listed = F.concat(F.lit("["), F.col("n_chars").cast("string"), F.lit(',["'), F.col("source"), F.lit('"],{}]'))
    value = F.when(kind == 0, nested).when(kind == 1, listed).when(kind == 2, "-0.0").otherwise("0.0")
    beside = F.when(F.col("doc_id") % 3 == 0, '{"v": NaN, "text": ').otherwise('{"text": ')
    fx.jsonl_folder(documents(spark, sf_dir), path, F.concat(beside, value, F.lit("}")), "doc_id")
    return placed(files.strict_json_lines(spark, path), ONE_INPUT)


@query(f"SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, {sql_clean('text')} AS text FROM documents")
def wiki_shards(spark, sf_dir):
    folder = fresh_path(spark, "extracted")
    value = F.to_json(F.struct("doc_id", "text"))
    fx.named_lines(documents(spark, sf_dir), f"{folder}/AA", value, "doc_id", "other", "")  # not read
    fx.named_lines(documents(spark, sf_dir), f"{folder}/AB", value, "doc_id", "wiki_", "")
    return placed(files.wiki_shards(spark, folder), files.ORDER[:-1])


def corpus_tree(spark, sf_dir) -> str:
    """A folder with every kind of file; documents are dealt by ``doc_id % 5``."""
    folder = fresh_path(spark, "tree")
    docs = documents(spark, sf_dir)

    def part(n: int) -> DataFrame:
        return docs.where(F.col("doc_id") % 5 == n)

    record = F.to_json(F.struct("text"))
    fx.named_lines(part(0), f"{folder}/b", record, "doc_id", "part", ".jsonl")
    fx.json_files(part(1), f"{folder}/a", "text", "doc_id")
    fx.named_lines(part(2), folder, F.col("text"), "doc_id", "lines", ".txt")
    part(3).orderBy("doc_id").select("text").write.parquet(f"{folder}/rows")
    fx.named_lines(part(4), f"{folder}/c", record, "doc_id", "wiki_", "")
    return folder


TREE = """tree AS (
  SELECT doc_id % 5 AS c, doc_id, 0 AS i, text AS raw FROM documents WHERE doc_id % 5 <> 2 UNION ALL
  SELECT 2, doc_id, generate_subscripts(string_split(text, chr(10)), 1), unnest(string_split(text, chr(10)))
  FROM documents WHERE doc_id % 5 = 2)"""


@query(f"""WITH {TREE} SELECT row_number() OVER (ORDER BY c, doc_id, i) - 1 AS place, {sql_clean('raw')} AS text FROM tree""")
def multi_source(spark, sf_dir):
    missing = fresh_path(spark, "missing")
    return placed(files.read_corpus(spark, [missing, corpus_tree(spark, sf_dir)]), files.ORDER[:-1])


LISTED = {"b": (".jsonl", 0, "jsonl"), "a": (".json", 1, "json"), "a/deep": (".json", 1, "json"), "c": (".txt", 2, "txt")}  # folder: suffix, class, kind
LISTED_SQL = " UNION ALL ".join(
    f"SELECT DISTINCT {c} AS file_class, '{kind}' AS kind, '{folder}/' || lpad(CAST(doc_id // {fx.FILE_DOCS} AS VARCHAR), 12, '0') || '{suffix}' AS path "
    f"FROM documents WHERE doc_id % {len(LISTED)} = {n}" for n, (folder, (suffix, c, kind)) in enumerate(LISTED.items()))


@query(f"""SELECT row_number() OVER (ORDER BY file_class, string_split(path, '/')) - 1 AS place, file_class, kind, path FROM ({LISTED_SQL})""")
def input_files(spark, sf_dir):
    """Every file by its place in reading order; documents are dealt to the folders, a file holds a range of ids."""
    folder, docs = fresh_path(spark, "listed"), documents(spark, sf_dir)
    for n, (name, (suffix, _, _)) in enumerate(LISTED.items()):
        fx.json_files(docs.where(F.col("doc_id") % len(LISTED) == n), f"{folder}/{name}", "text", "doc_id", suffix)
    found = stage(files.input_files(spark, folder), "files")
    numbered = order.position(found, "place", [F.col("file_class")], [F.col("file_parts")])
    path = F.substring_index(F.array_join("file_parts", "/"), "/listed/", -1)
    return numbered.select("place", "file_class", "kind", path.alias("path"))


# --- sources one after another and interleaved -------------------------------------------------------

INPUTS = 4
PER_INPUT = f"""parts AS (SELECT doc_id, doc_id * 7 % 5 % {INPUTS} AS src_ord FROM documents)"""


def split_documents(spark, sf_dir) -> list[DataFrame]:
    """Inputs of different size: the first holds two fifths of the documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return [docs.where(F.col("doc_id") * 7 % 5 % INPUTS == n) for n in range(INPUTS)]


@query(f"WITH {PER_INPUT} SELECT src_ord, doc_id, row_number() OVER (ORDER BY src_ord, doc_id) - 1 AS place FROM parts")
def concat_sources(spark, sf_dir):
    rows = order.concat_sources(split_documents(spark, sf_dir)).select("src_ord", "doc_id")
    return order.concat_position(rows, "doc_id").select("src_ord", "doc_id", "place")


def sql_mixed(rows: str, source: str, key: str) -> str:
    """Tables ``mixing`` and ``mixed_rows`` (with ``place``) over ``rows``."""
    uniform = f"(CAST('0x' || substr(md5('{SEED}:' || {source} || ':' || k), 1, 8) AS BIGINT) + 1) / 4294967296.0"
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY {source} ORDER BY {key}) - 1 AS k FROM {rows}),
mixing AS (SELECT *, sum(CAST(floor(-ln({uniform}) * 1048576) AS BIGINT) + 1)
  OVER (PARTITION BY {source} ORDER BY {key}) AS arrival FROM numbered),
mixed_rows AS (SELECT *, row_number() OVER (ORDER BY arrival, {source}) - 1 AS place FROM mixing)"""


@query(f"WITH {sql_mixed('documents', 'source', 'doc_id')} SELECT source, doc_id, place FROM mixed_rows")
def mix_sources(spark, sf_dir):
    docs = documents(spark, sf_dir).select("source", "doc_id")
    return order.mix_sources(docs, "source", "doc_id", SEED).select("source", "doc_id", "place")


# --- conversion --------------------------------------------------------------------------------------

DICTIONARY = {"ä": "a", "ö": "o", "ü": "u", "é": "e", "ungen": "UNGEN", "ung": "-ung", "tion": "TION!", "ß": "ss"}


@query("""SELECT doc_id, replace(replace(replace(replace(translate(
  replace(replace(replace(replace(text, 'ungen', chr(1)), 'ung', chr(2)), 'tion', chr(3)), 'ß', chr(4)),
  'äöüé', 'aoue'), chr(1), 'UNGEN'), chr(2), '-ung'), chr(3), 'TION!'), chr(4), 'ss') AS text FROM documents""")
def convert_dict(spark, sf_dir):
    return convert.convert(documents(spark, sf_dir), "text", DICTIONARY).select("doc_id", "text")


@query("SELECT doc_id, translate(text, 'äöüé', 'aoue') AS text FROM documents")
def convert_chars(spark, sf_dir):
    single = {s: d for s, d in DICTIONARY.items() if len(s) == len(d) == 1}
    return convert.convert(documents(spark, sf_dir), "text", single).select("doc_id", "text")


@query("""SELECT doc_id, translate(text, 'äöüé', 'aoue') AS text FROM documents""")
def convert_large_dict(spark, sf_dir):
    """Two entries for every document that no text holds, repeated and null ones, and those of ``convert_chars``."""
    docs = documents(spark, sf_dir)
    unused = docs.selectExpr("explode(array(concat('\\u0001', doc_id), concat('ä\\u0001', doc_id))) AS src", "'never' AS dst")
    pairs = [("ä", "a"), ("ö", "z"), ("ö", "o"), ("ü", "u"), ("é", "e"), ("e", None), (None, "x"), ("", "y")]
    used = spark.createDataFrame(pairs, "src string, dst string")
    return convert.convert(docs, "text", unused.unionByName(used)).select("doc_id", "text")


# --- chat --------------------------------------------------------------------------------------------

# Conversations get numbers of this many places: a sample per user or unanswered turn, the last one empty.
PLACES = 1000


def questions(spark, sf_dir) -> DataFrame:
    """``conv_id, question, answer``: every user turn with the assistant turn after it, assistant turns that
    follow no user turn, and an empty sample per conversation. ``conv_id`` numbers the samples."""
    turns = conversations(spark, sf_dir).where("role IN ('user', 'assistant')")
    w = Window.partitionBy("conv_id").orderBy("turn")
    near = turns.select("conv_id", "turn", "role", "text", F.lag("role").over(w).alias("before"),
                        F.lead("role").over(w).alias("after"), F.lead("text").over(w).alias("reply"))
    near = near.where("role = 'user' OR before IS NULL OR before <> 'user'")
    user = F.col("role") == "user"
    pairs = near.select(
        (F.col("conv_id") * PLACES + F.col("turn")).alias("conv_id"), F.when(user, F.col("text")).otherwise("").alias("question"),
        F.when(~user, F.col("text")).when(F.col("after") == "assistant", F.col("reply")).otherwise("").alias("answer"))
    empty = turns.select((F.col("conv_id") * PLACES + (PLACES - 1)).alias("conv_id"), F.lit("").alias("question"), F.lit("").alias("answer"))
    return pairs.unionByName(empty.distinct())


QUESTIONS = f"""near AS (SELECT *, lag(role) OVER w AS b, lead(role) OVER w AS n, lead(text) OVER w AS r
  FROM conversations WHERE role IN ('user', 'assistant') WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
questions AS (SELECT conv_id * {PLACES} + turn AS conv_id, CASE WHEN role = 'user' THEN text ELSE '' END AS q,
    CASE WHEN role <> 'user' THEN text WHEN n = 'assistant' THEN r ELSE '' END AS a
  FROM near WHERE role = 'user' OR b IS NULL OR b <> 'user' UNION ALL
  SELECT DISTINCT conv_id * {PLACES} + {PLACES - 1}, '', '' FROM near)"""


def chat_record(question: Column, answer: Column, number: Column) -> Column:
    """JSON lines of chat samples in several shapes."""
    def obj(**fields) -> Column:
        return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))

    kind = number % 6
    turns = F.array(C.message("user", question), C.message("assistant", answer))
    inner = F.regexp_replace(obj(output=answer), r"^\{", "")
    said = F.regexp_replace(obj(content=answer), r"^\{", "")
    empty = F.when(number % (2 * PLACES) < PLACES, '{"messages": [], "instruction": "unused"}').otherwise('{"messages": null}')
    return (
        F.when(number % PLACES == PLACES - 1, empty)
        .when(kind == 0, obj(instruction=question, input=F.lit(" \t"), output=answer))
        .when(kind == 1, obj(human=question, assistant=answer))
        .when(kind == 2, obj(instruction=question, input=F.lit(" extra\n"), output=answer))
        .when(kind == 3, obj(messages=turns, instruction=F.lit("unused")))
        .when(kind == 4, F.concat(F.lit('{"instruction": null, "human": "unused", '), inner))
        .otherwise(F.concat(F.lit('{"messages": [{"role": "user", "content": null}, {"role": "assistant", '), said,
                            F.lit(', {"role": "tool", "content": 1.0}, {"role": "tool", "content": true}], "x": NaN}')))
    )


def sql_turn(role: str, content: str) -> str:
    return f"'<|im_start|>' || {role} || chr(10) || {content} || '<|im_end|>' || chr(10)"


SYSTEM = sql_turn("'system'", f"'{C.SYSTEM_TEXT}'")
CHAT_TEXT = f"""CASE conv_id % 6
  WHEN 2 THEN {SYSTEM} || {sql_turn("'user'", sql_strip('q') + " || chr(10) || chr(10) || '输入：' || chr(10) || 'extra'")}
    || {sql_turn("'assistant'", sql_strip('a'))}
  WHEN 3 THEN {sql_turn("'user'", 'q')} || {sql_turn("'assistant'", 'a')}
  WHEN 4 THEN {SYSTEM} || {sql_turn("'user'", "'None'")} || {sql_turn("'assistant'", sql_strip('a'))}
  WHEN 5 THEN {sql_turn("'user'", "'None'")} || {sql_turn("'assistant'", 'a')} || {sql_turn("'tool'", "'1.0'")} || {sql_turn("'tool'", "'True'")}
  ELSE {SYSTEM} || {sql_turn("'user'", sql_strip('q'))} || {sql_turn("'assistant'", sql_strip('a'))} END"""


@query(f"WITH {QUESTIONS} SELECT conv_id, {CHAT_TEXT} AS chat FROM questions WHERE conv_id % {PLACES} <> {PLACES - 1}")
def instruction_to_messages(spark, sf_dir):
    line = F.regexp_replace(chat_record(F.col("question"), F.col("answer"), F.col("conv_id")), ', "x": NaN}$', "}")
    rows = questions(spark, sf_dir).select("conv_id", F.parse_json(line).alias("record"))
    chats = rows.select("conv_id", C.record_messages(F.col("record")).alias("messages")).where(F.size("messages") > 0)
    return chats.select("conv_id", C.render_chat(F.col("messages")).alias("chat"))


@query(f"WITH {QUESTIONS} SELECT row_number() OVER (ORDER BY conv_id) - 1 AS place, {CHAT_TEXT} AS chat FROM questions WHERE conv_id % {PLACES} <> {PLACES - 1}")
def chat_samples(spark, sf_dir):
    path = fresh_path(spark, "chats.jsonl")
    line = chat_record(F.col("question"), F.col("answer"), F.col("conv_id"))
    fx.jsonl_folder(questions(spark, sf_dir), path, line, "conv_id")
    chats = order.block_sequence(stage(samples.chat_samples(spark, path), "chats"), ONE_INPUT, "pos")
    numbered = order.position(chats, "place", [F.shiftright("seq", 16)], [F.col("seq")])
    return numbered.select("place", C.render_chat(F.col("messages")).alias("chat"))


@query(f"SELECT conv_id, turn, {sql_turn('role', 'text')} AS turn_text FROM conversations")
def render_chat(spark, sf_dir):
    turn_text = C.render_message(F.col("role"), F.col("text"))
    return conversations(spark, sf_dir).select("conv_id", "turn", turn_text.alias("turn_text"))


@query(f"""WITH {QUESTIONS} SELECT conv_id, {SYSTEM} || {sql_turn("'user'", 'q')} || '<|im_start|>assistant' || chr(10) AS prompt
FROM questions""")
def generation_prompt(spark, sf_dir):
    return questions(spark, sf_dir).select("conv_id", C.generation_prompt(F.col("question")).alias("prompt"))


# --- samples: code points stand for token ids, so that SQL can follow ---------------------------------

def code_points(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c))


def sql_points(text: str) -> str:
    return f"[unicode(c) FOR c IN string_split({text}, '') IF c <> '']"


@query(f"""WITH s AS (SELECT doc_id, list_resize((list_concat([1], ({sql_points('text')})[1:{LENGTH - 2}], [2]))[1:{LENGTH + 1}],
  {LENGTH + 1}, 2) AS ids FROM documents)
SELECT doc_id, array_to_string(ids[1:{LENGTH}], ',') AS input_ids,
  array_to_string([CASE WHEN v = 2 THEN -100 ELSE v END FOR v IN ids[2:{LENGTH + 1}]], ',') AS labels FROM s""")
def pretrain_layout(spark, sf_dir):
    ids = documents(spark, sf_dir).select("doc_id", code_points(F.col("text")).alias("ids"))
    sample = ids.select("doc_id", encode.pretrain_sample(F.col("ids"), LENGTH).alias("s"))
    return sample.select("doc_id", shown(F.col("s.input_ids")).alias("input_ids"), shown(F.col("s.labels")).alias("labels"))


L1 = CHAT_LENGTH + 1


@query(f"""WITH t AS (SELECT conv_id, turn, role, ({sql_points('(' + sql_turn('role', 'text') + ')')})[1:{L1}] AS ids FROM conversations),
c AS (SELECT conv_id, flatten(list(ids ORDER BY turn)) AS ids, flatten(list(
  CASE WHEN role = 'assistant' THEN ids ELSE [-100 FOR v IN ids] END ORDER BY turn)) AS marks FROM t GROUP BY conv_id),
s AS (SELECT conv_id, list_resize((list_concat([1], ids, [2]))[1:{L1}], {L1}, 2) AS ids,
  list_resize((list_concat([-100], marks, [2]))[1:{L1}], {L1}, -100) AS marks FROM c)
SELECT conv_id, array_to_string(ids[1:{CHAT_LENGTH}], ',') AS input_ids, array_to_string(marks[2:{L1}], ',') AS labels FROM s""")
def sft_layout(spark, sf_dir):
    turns = encode.first_turns(conversations(spark, sf_dir), "conv_id", "turn", CHAT_LENGTH)
    rows = turns.withColumn("ids", code_points(C.render_message(F.col("role"), F.col("text"))))
    out = encode.layout_turns(rows.withColumn("ids", F.slice("ids", 1, L1)), CHAT_LENGTH, "conv_id", "turn")
    return out.select("conv_id", shown(F.col("input_ids")).alias("input_ids"), shown(F.col("labels")).alias("labels"))


# --- vocabulary ----------------------------------------------------------------------------------------

_W = r"\t\n\x0b\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def sql_pretokens(text: str) -> str:
    """A list in which chr(1) has to be left out: RE2 has no look-ahead, so one is put before the last blank of
    a run that a word follows."""
    return rf"""regexp_extract_all(
    regexp_replace({text}, '([{_W}])([{_W}][^{_W}])', '\1' || chr(1) || '\2', 'g'),
    '''s|''t|''re|''ve|''m|''ll|''d| ?\pL+| ?\pN+| ?[^{_W}\pL\pN\x01]+|[{_W}]+|\x01')"""


PRETOKENS = rf"""pieces AS (SELECT unnest({sql_pretokens('text')}) AS word FROM documents),
words AS (SELECT word, count(*) AS freq FROM pieces WHERE word <> chr(1) GROUP BY word)"""


@query(f"WITH {PRETOKENS} SELECT word, freq FROM words")
def pretoken_freq(spark, sf_dir):
    return vocab.pretoken_freq(documents(spark, sf_dir))


@query(f"""WITH {PRETOKENS}, h AS (SELECT hex(encode(word)) AS h, freq FROM words),
p AS (SELECT h, freq, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 1)) AS i FROM h)
SELECT substr(h, 2 * i + 1, 2) AS left_byte, substr(h, 2 * i + 3, 2) AS right_byte, CAST(sum(freq) AS BIGINT) AS n
FROM p GROUP BY 1, 2""")
def pair_count(spark, sf_dir):
    pairs = vocab.pair_count(vocab.symbol_words(vocab.pretoken_freq(documents(spark, sf_dir))))

    def byte_at(place: int) -> Column:
        return F.hex(vocab.symbol_bytes(F.substr("pair", F.lit(place), F.lit(1))))

    return pairs.select(byte_at(1).alias("left_byte"), byte_at(2).alias("right_byte"), "n")


@query(f"""WITH h AS (SELECT hex(encode(text)) AS h FROM documents),
b AS (SELECT DISTINCT unnest([substr(h, 2 * i + 1, 2) FOR i IN range(0, CAST(length(h) / 2 AS BIGINT))]) AS byte FROM h)
SELECT byte FROM b""")
def byte_alphabet(spark, sf_dir):
    seen = vocab.alphabet(documents(spark, sf_dir).select(vocab.byte_symbols(X.nfkc(F.col("text"))).alias("sym")))
    return seen.select(F.hex(vocab.symbol_bytes(F.col("token"))).alias("byte"))


# Characters that NFKC takes back: wide letters and figures, a ligature, a wide blank.
WIDE = {c: chr(ord(c) + 0xFEE0) for c in "abcxyzABC0189!?"} | {" ": "\u3000"}


@query("SELECT doc_id, text FROM documents")
def nfkc_text(spark, sf_dir):
    """Every text is written with other characters first; holds because every document is its own NFKC form."""
    text = F.translate(F.replace("text", F.lit("fi"), F.lit("\ufb01")), "".join(WIDE), "".join(WIDE.values()))
    return documents(spark, sf_dir).select("doc_id", X.nfkc(text).alias("text"))


# Training in SQL: words are strings of ids, each step merges the best pair (ties: smaller ids) in all words.
SPECIALS = len(vocab.SPECIAL_TOKENS)
TRAINED = rf"""{PRETOKENS}, numbered_words AS (SELECT row_number() OVER () AS w, word, hex(encode(word)) AS h, freq FROM words),
places AS (SELECT w, freq, i, substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS byte FROM (
  SELECT w, freq, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT))) AS i FROM numbered_words)),
seen_bytes AS (SELECT byte, CAST('0x' || byte AS INTEGER) AS n FROM (SELECT DISTINCT byte FROM places)),
shown_bytes AS (SELECT byte, CASE WHEN n BETWEEN 33 AND 126 OR n BETWEEN 161 AND 172 OR n >= 174 THEN n
  WHEN n <= 32 THEN 256 + n WHEN n <= 160 THEN 256 + 33 + n - 127 ELSE 256 + 33 + 34 END AS code FROM seen_bytes),
alphabet AS (SELECT byte, chr(code) AS token, {SPECIALS - 1} + row_number() OVER (ORDER BY code) AS id FROM shown_bytes),
base AS (SELECT {SPECIALS} + count(*) AS base FROM alphabet),
steps AS (
  SELECT 0 AS step, w, string_agg('<' || id || '>', '' ORDER BY i) AS sym, any_value(freq) AS freq, 0 AS l, 0 AS r
  FROM places JOIN alphabet USING (byte) GROUP BY w UNION ALL
  SELECT step + 1, w, replace(sym, '<' || best.l || '><' || best.r || '>', '<' || (base + step) || '>'), freq, best.l, best.r
  FROM steps, base, (
    SELECT l, r FROM (
      SELECT ids[i] AS l, ids[i + 1] AS r, freq FROM (
        SELECT ids, freq, unnest(range(1, len(ids))) AS i FROM (
          SELECT list_transform(regexp_extract_all(sym, '[0-9]+'), lambda x: CAST(x AS INTEGER)) AS ids, freq FROM steps)))
    GROUP BY l, r HAVING sum(freq) >= 2 ORDER BY sum(freq) DESC, l, r LIMIT 1) AS best
  WHERE base + step < {VOCAB_SIZE}),
merges AS MATERIALIZED (SELECT DISTINCT step - 1 AS rank, l, r, base + step - 1 AS new_id FROM steps, base WHERE step > 0)"""

_TRAINED: dict[tuple[str, str], vocab.Vocabulary] = {}


def trained(spark, sf_dir) -> vocab.Vocabulary:
    """The vocabulary of the documents, trained once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        _TRAINED[key] = vocab.train_bpe(vocab.pretoken_freq(spread(documents(spark, sf_dir))), VOCAB_SIZE)
    return _TRAINED[key]


@query(f"""WITH RECURSIVE {TRAINED} SELECT CAST(rank AS INTEGER) AS rank, CAST(l AS INTEGER) AS "left", CAST(r AS INTEGER) AS "right",
  CAST(new_id AS INTEGER) AS new_id FROM merges""")
def bpe_merges(spark, sf_dir):
    return trained(spark, sf_dir).merges_table(spark)


VOCABULARY = f"""WITH RECURSIVE {TRAINED},
spelled AS (
  SELECT CAST(0 AS BIGINT) AS step, {list(vocab.SPECIAL_TOKENS)} || (SELECT list(token ORDER BY id) FROM alphabet) AS tokens UNION ALL
  SELECT step + 1, list_append(tokens, tokens[l + 1] || tokens[r + 1]) FROM spelled JOIN merges ON rank = step),
longest AS (SELECT tokens FROM spelled ORDER BY step DESC LIMIT 1)
SELECT CAST(unnest(range(0, len(tokens))) AS INTEGER) AS id, unnest(tokens) AS token FROM longest"""


@query(VOCABULARY)
def bpe_vocab(spark, sf_dir):
    path = fresh_path(spark, "vocabulary")
    vocab.save_vocabulary(spark, trained(spark, sf_dir), path)
    return spark.read.parquet(f"{path}/vocab")


@query(ORACLES["bpe_merges"])
def bpe_saved_merges(spark, sf_dir):
    path = fresh_path(spark, "vocabulary")
    vocab.save_vocabulary(spark, trained(spark, sf_dir), path)
    return spark.read.parquet(f"{path}/merges")


@query(VOCABULARY)
def bpe_tokenizer_file(spark, sf_dir):
    path = fresh_path(spark, "vocabulary")
    vocab.save_vocabulary(spark, trained(spark, sf_dir), path)
    parsed = F.from_json("value", "model struct<vocab: map<string, int>>")
    return spark.read.text(f"{path}/tokenizer_json", wholetext=True).select(F.explode(parsed["model"]["vocab"]).alias("token", "id"))


# --- encoding --------------------------------------------------------------------------------------------

SAMPLE_LENGTH = 512


def sql_encoded(rows: str) -> str:
    """``encoded``: k and ids of every row (k, text) of ``rows``, by the merges of ``TRAINED``.

    Special tokens are cut out first: of the parts at chr(2) every second one is the id of a special
    token. The merges are applied in rank order to each distinct word, and words are joined back by
    place. The texts' only character that NFKC changes is the wide colon.
    """
    marked = "replace(text, '：', ':')"
    for i, token in enumerate(vocab.SPECIAL_TOKENS):
        marked = f"replace({marked}, '{token}', chr(2) || '{i}' || chr(2))"
    return rf"""cut_rows AS (SELECT k, string_split({marked}, chr(2)) AS parts FROM {rows}),
parts AS (SELECT k, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS part FROM cut_rows),
part_words AS (SELECT k, i, [w FOR w IN {sql_pretokens('part')} IF w <> chr(1)] AS ws FROM parts WHERE i % 2 = 1),
places_of AS (SELECT k, i, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM part_words),
to_code AS (SELECT DISTINCT word FROM places_of),
coded_bytes AS (SELECT word, i, substr(hex(encode(word)), CAST(2 * i + 1 AS BIGINT), 2) AS byte FROM (
  SELECT word, unnest(range(0, octet_length(encode(word)))) AS i FROM to_code)),
coded AS (
  SELECT 0 AS step, word, string_agg('<' || coalesce(id, {vocab.UNK_ID}) || '>', '' ORDER BY i) AS sym
  FROM coded_bytes LEFT JOIN alphabet USING (byte) GROUP BY word UNION ALL
  SELECT step + 1, word, replace(sym, '<' || l || '><' || r || '>', '<' || new_id || '>') FROM coded JOIN merges ON rank = step),
word_ids AS (SELECT word, [CAST(x AS INTEGER) FOR x IN regexp_extract_all(sym, '[0-9]+')] AS ids
  FROM coded WHERE step = (SELECT count(*) FROM merges)),
pieces_of AS (SELECT k, i, j, ids FROM places_of JOIN word_ids USING (word) UNION ALL
  SELECT k, i, 0, [CAST(part AS INTEGER)] FROM parts WHERE i % 2 = 0),
joined_ids AS (SELECT k, flatten(list(ids ORDER BY i, j)) AS ids FROM pieces_of GROUP BY k),
encoded AS (SELECT k, coalesce(ids, []) AS ids FROM {rows} LEFT JOIN joined_ids USING (k))"""


def sql_documents_laid_out(length: int) -> str:
    """``laid_out``: k, input_ids and labels of ``encoded``."""
    return f"""filled AS (SELECT k, list_resize((list_concat([{vocab.BOS_ID}], ids[1:{length - 2}], [{vocab.EOS_ID}]))[1:{length + 1}],
  {length + 1}, {vocab.PAD_ID}) AS ids FROM encoded),
laid_out AS (SELECT k, array_to_string(ids[1:{length}], ',') AS input_ids,
  array_to_string([CASE WHEN v = {vocab.PAD_ID} THEN -100 ELSE v END FOR v IN ids[2:{length + 1}]], ',') AS labels FROM filled)"""


def sql_chats_laid_out(length: int, chat: str, turn: str, role: str) -> str:
    """The same of ``encoded`` turns: the three are taken from a turn's k."""
    last = length + 1
    return f"""turn_ids AS (SELECT {chat} AS chat, {turn} AS turn, {role} AS role, ids[1:{last}] AS ids FROM encoded),
chat_ids AS (SELECT chat, flatten(list(ids ORDER BY turn)) AS ids, flatten(list(
  CASE WHEN role = 'assistant' THEN ids ELSE [-100 FOR v IN ids] END ORDER BY turn)) AS marks FROM turn_ids GROUP BY chat),
filled AS (SELECT chat, list_resize((list_concat([{vocab.BOS_ID}], ids, [{vocab.EOS_ID}]))[1:{last}], {last}, {vocab.PAD_ID}) AS ids,
  list_resize((list_concat([-100], marks, [{vocab.EOS_ID}]))[1:{last}], {last}, -100) AS marks FROM chat_ids),
laid_out AS (SELECT chat AS k, array_to_string(ids[1:{length}], ',') AS input_ids, array_to_string(marks[2:{last}], ',') AS labels FROM filled)"""


@query(f"""WITH RECURSIVE {TRAINED}, texts_in AS (SELECT doc_id AS k, text FROM documents), {sql_encoded('texts_in')},
{sql_documents_laid_out(SAMPLE_LENGTH)} SELECT k AS doc_id, input_ids, labels FROM laid_out""")
def encode_text(spark, sf_dir):
    enc = encode.encoder(spark, trained(spark, sf_dir))
    out = encode.encode_documents(documents(spark, sf_dir).select("doc_id", "text"), enc, SAMPLE_LENGTH)
    return out.select("doc_id", shown(F.col("input_ids")).alias("input_ids"), shown(F.col("labels")).alias("labels"))


@query(f"""WITH RECURSIVE {TRAINED}, turns_in AS (
  SELECT {{'chat': conv_id, 'turn': turn, 'role': role}} AS k, {sql_turn('role', 'text')} AS text FROM conversations),
{sql_encoded('turns_in')}, {sql_chats_laid_out(SAMPLE_LENGTH, 'k.chat', 'k.turn', 'k.role')}
SELECT k AS conv_id, input_ids, labels FROM laid_out""")
def encode_chat(spark, sf_dir):
    enc = encode.encoder(spark, trained(spark, sf_dir))
    out = encode.encode_turns(conversations(spark, sf_dir), enc, SAMPLE_LENGTH)
    return out.select("conv_id", shown(F.col("input_ids")).alias("input_ids"), shown(F.col("labels")).alias("labels"))


@query(f"""WITH RECURSIVE {TRAINED}, {QUESTIONS}, prompts AS (
  SELECT conv_id AS k, {SYSTEM} || {sql_turn("'user'", 'q')} || '<|im_start|>assistant' || chr(10) AS text FROM questions),
{sql_encoded('prompts')} SELECT k AS conv_id, array_to_string(ids, ',') AS ids FROM encoded""")
def encode_prompt(spark, sf_dir):
    enc = encode.encoder(spark, trained(spark, sf_dir))
    return questions(spark, sf_dir).select("conv_id", shown(enc(C.generation_prompt(F.col("question")))).alias("ids"))


@query("SELECT doc_id, text FROM documents")
def decode_roundtrip(spark, sf_dir):
    """Holds as it stands because every document is its own NFKC form and names no special token."""
    words = trained(spark, sf_dir)
    ids = documents(spark, sf_dir).select("doc_id", encode.encoder(spark, words)(F.col("text")).alias("ids"))
    return ids.select("doc_id", encode.decode(F.col("ids"), words).alias("text"))


@query(f"WITH {QUESTIONS} SELECT conv_id, {sql_strip('a')} AS reply FROM questions")
def decode_reply(spark, sf_dir):
    words = trained(spark, sf_dir)
    enc = encode.encoder(spark, words)
    rows = questions(spark, sf_dir).select(
        "conv_id", enc(C.generation_prompt(F.col("question"))).alias("prompt"),
        enc(F.concat(F.lit("\n"), F.col("answer"), F.lit("</s>"))).alias("made"))
    reply = encode.decode_reply(F.concat("prompt", "made"), F.size("prompt"), words)
    return rows.select("conv_id", reply.alias("reply"))


# --- training feed ---------------------------------------------------------------------------------------

SHARDS = f"""epochs AS (SELECT unnest(range(0, {EPOCHS})) AS epoch),
ordered AS (SELECT epoch, doc_id, row_number() OVER (
    PARTITION BY epoch ORDER BY md5('{SEED}:' || epoch || ':' || doc_id), doc_id) - 1 AS pos FROM documents, epochs),
size AS (SELECT count(*) AS n, CAST(ceil(count(*) / {RANKS}) AS BIGINT) * {RANKS} AS padded FROM documents),
places AS (SELECT n, unnest(range(0, padded)) AS p FROM size),
shards AS (SELECT CAST(epoch AS INTEGER) AS epoch, CAST(p % {RANKS} AS INTEGER) AS rank, p // {RANKS} AS place, doc_id
  FROM places JOIN ordered ON pos = p % n)"""


@query(f"WITH {SHARDS} SELECT epoch, rank, place, doc_id FROM shards")
def epoch_shards(spark, sf_dir):
    return feed.shard_rows(documents(spark, sf_dir).select("doc_id"), "doc_id", RANKS, EPOCHS, SEED)


@query(f"""WITH {SHARDS} SELECT epoch, rank, place // {BATCH} AS batch_id, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY place) AS rows
FROM shards GROUP BY ALL""")
def batches(spark, sf_dir):
    shards = feed.shard_rows(documents(spark, sf_dir).select("doc_id"), "doc_id", RANKS, EPOCHS, SEED)
    grouped = feed.batches(shards, BATCH, ["doc_id"])
    return grouped.select("epoch", "rank", "batch_id", shown(F.col("doc_id")).alias("rows"))


@query(f"""WITH s AS (SELECT count(*) AS samples FROM documents WHERE {sql_strip('text')} <> ''),
r AS (SELECT samples, CAST(ceil(samples / {RANKS}) AS BIGINT) AS rank_samples FROM s),
b AS (SELECT *, CAST(ceil(rank_samples / {BATCH}) AS BIGINT) AS batches FROM r),
p AS (SELECT *, CAST(ceil(batches / 8) AS BIGINT) AS steps_per_epoch FROM b)
SELECT *, steps_per_epoch * {EPOCHS} AS total_steps FROM p""")
def training_steps(spark, sf_dir):
    rows = documents(spark, sf_dir).where(X.strip(F.col("text")) != "")
    return report.training_steps(rows, BATCH, 8, RANKS, EPOCHS)


# --- sinks and sample sources ------------------------------------------------------------------------------

@query(f"SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, {sql_strip('text')} AS text FROM documents WHERE {sql_strip('text')} <> ''")
def jsonl_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "corpus.jsonl")
    sinks.write_corpus(documents(spark, sf_dir), path, ["doc_id"])
    read = order.block_sequence(stage(samples.pretrain_samples(spark, path), "read"), ONE_INPUT, "pos")
    numbered = order.position(read.select("seq", "text"), "place", [F.shiftright("seq", 16)], [F.col("seq")])
    return numbered.select("place", "text")


@query(f"""WITH t AS (SELECT {sql_strip('line')} AS text FROM (SELECT unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE doc_id % 2 = 0) UNION ALL SELECT {sql_strip('text')} FROM documents WHERE doc_id % 2 = 1)
SELECT text, count(*) AS n FROM t WHERE text <> '' GROUP BY text""")
def tokenizer_texts(spark, sf_dir):
    folder = fresh_path(spark, "tokenizer")
    docs = documents(spark, sf_dir)
    fx.named_lines(docs.where("doc_id % 2 = 0"), folder, F.col("text"), "doc_id", "a", ".txt")
    fx.named_lines(docs.where("doc_id % 2 = 1"), folder, F.to_json(F.struct("text")), "doc_id", "b", ".jsonl")
    return samples.tokenizer_texts(spark, folder).groupBy("text").agg(F.count("*").alias("n"))


# --- whole builds --------------------------------------------------------------------------------------------

def corpus_inputs(spark, sf_dir) -> list[str]:
    paths = []
    for n, part in enumerate(split_documents(spark, sf_dir)):
        paths.append(fresh_path(spark, f"input{n}.jsonl"))
        fx.jsonl_folder(part, paths[-1], F.to_json(F.struct("text")), "doc_id")
    return paths


def read_back(spark, path: str) -> DataFrame:
    return placed(files.json_lines(spark, path), ONE_INPUT)


def sql_built(order_by: str, rows: str, budget: str = BUDGET) -> str:
    """``built``: status of every record of ``rows``, up to the byte budget (none if empty)."""
    most = X.parse_size(budget) or "9e18"
    return f"""texts AS (SELECT *, {sql_clean('text')} AS t FROM {rows}),
status AS (SELECT {order_by} AS seq, t, {sql_bytes('t')} AS b, CASE WHEN length(t) < {MIN_CHARS} THEN 'short'
  WHEN row_number() OVER (PARTITION BY t ORDER BY {order_by}) > 1 THEN 'repeat' ELSE 'kept' END AS s FROM texts),
running AS (SELECT *, sum(CASE WHEN s = 'kept' THEN b ELSE 0 END) OVER (ORDER BY seq) AS total FROM status),
built AS (SELECT * FROM running
  WHERE seq < coalesce((SELECT min(seq) FROM running WHERE s = 'kept' AND total > {most}), 9e18))"""


IN_TURN = f"""inputs AS (SELECT *, doc_id * 7 % 5 % {INPUTS} AS src_ord FROM documents),
lined AS (SELECT *, row_number() OVER (ORDER BY src_ord, doc_id) AS line FROM inputs)"""
PLACED = "SELECT row_number() OVER (ORDER BY seq) - 1 AS place, t AS text FROM built WHERE s = 'kept'"


def built(spark, sf_dir, mix: bool, budget: str = BUDGET) -> tuple[str, DataFrame]:
    path = fresh_path(spark, "built.jsonl")
    counters = corpus.build_corpus(
        spark, corpus_inputs(spark, sf_dir), path, MIN_CHARS, budget, dedupe=True, mix=mix, seed=SEED)
    return path, counters


@query(f"WITH {IN_TURN}, {sql_built('line', 'lined')} {PLACED}")
def corpus_build(spark, sf_dir):
    return read_back(spark, built(spark, sf_dir, mix=False)[0])


@query(f"WITH {IN_TURN}, {sql_mixed('lined', 'src_ord', 'doc_id')}, {sql_built('place', 'mixed_rows')} {PLACED}")
def corpus_build_mixed(spark, sf_dir):
    return read_back(spark, built(spark, sf_dir, mix=True)[0])


@query(f"WITH {IN_TURN}, {sql_mixed('lined', 'src_ord', 'doc_id')}, {sql_built('place', 'mixed_rows')} SELECT {COUNTERS} FROM built")
def corpus_build_report(spark, sf_dir):
    return built(spark, sf_dir, mix=True)[1]


@query(f"WITH {IN_TURN}, {sql_built('line', 'lined', '')} {PLACED}")
def corpus_build_all(spark, sf_dir):
    return read_back(spark, built(spark, sf_dir, False, "")[0])


@query(f"WITH {IN_TURN}, {sql_mixed('lined', 'src_ord', 'doc_id')}, {sql_built('place', 'mixed_rows', '')} {PLACED}")
def corpus_build_all_mixed(spark, sf_dir):
    return read_back(spark, built(spark, sf_dir, True, "")[0])


def wiki_build(spark, sf_dir, max_docs: int = 0) -> tuple[str, DataFrame]:
    folder, out = fresh_path(spark, "extracted"), fresh_path(spark, "wiki.jsonl")
    fx.named_lines(documents(spark, sf_dir), f"{folder}/AA", F.to_json(F.struct("text")), "doc_id", "wiki_", "")
    single = {s: d for s, d in DICTIONARY.items() if len(s) == len(d) == 1}
    return out, corpus.prepare_wiki(spark, folder, out, MIN_CHARS, max_docs, single)


@query(f"""WITH {CLEANED} SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, translate(t, 'äöüé', 'aoue') AS text
FROM cleaned WHERE length(t) >= {MIN_CHARS}""")
def wiki_corpus_all(spark, sf_dir):
    return read_back(spark, wiki_build(spark, sf_dir)[0])


@query(f"WITH {CLEANED} SELECT count(*) AS saved FROM cleaned WHERE length(t) >= {MIN_CHARS}")
def wiki_count(spark, sf_dir):
    return wiki_build(spark, sf_dir)[1]


@query(f"""WITH {CLEANED}, kept AS (SELECT translate(t, 'äöüé', 'aoue') AS text, doc_id FROM cleaned
  WHERE length(t) >= {MIN_CHARS} ORDER BY doc_id LIMIT 150)
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, text FROM kept""")
def wiki_corpus(spark, sf_dir):
    return read_back(spark, wiki_build(spark, sf_dir, 150)[0])


def sql_fed(samples: str) -> str:
    """Samples (k from 0) in one epoch's order, dealt to the ranks."""
    return f"""shuffled AS (SELECT k, row_number() OVER (ORDER BY md5('{SEED}:0:' || k), k) - 1 AS pos FROM {samples}),
fed_size AS (SELECT count(*) AS n, CAST(ceil(count(*) / {RANKS}) AS BIGINT) * {RANKS} AS padded FROM {samples}),
fed_places AS (SELECT n, unnest(range(0, padded)) AS p FROM fed_size)
SELECT CAST(0 AS INTEGER) AS epoch, CAST(p % {RANKS} AS INTEGER) AS rank, p // {RANKS} AS place, k AS "row", input_ids, labels
FROM fed_places JOIN shuffled ON pos = p % n JOIN laid_out USING (k)"""


@query(f"""WITH RECURSIVE {TRAINED}, samples_in AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS k, {sql_strip('text')} AS text
  FROM documents WHERE {sql_strip('text')} <> ''), {sql_encoded('samples_in')},
{sql_documents_laid_out(SAMPLE_LENGTH)}, {sql_fed('samples_in')}""")
def pretrain_feed(spark, sf_dir):
    data, out = fresh_path(spark, "corpus.jsonl"), fresh_path(spark, "feed")
    sinks.write_corpus(documents(spark, sf_dir), data, ["doc_id"])
    training.pretrain_feed(spark, data, trained(spark, sf_dir), out, SAMPLE_LENGTH, RANKS, 1, SEED)
    return _fed(spark, out)


@query(f"""WITH RECURSIVE {TRAINED}, {QUESTIONS}, chats AS (
  SELECT row_number() OVER (ORDER BY conv_id) - 1 AS k, {CHAT_TEXT} AS chat FROM questions WHERE conv_id % {PLACES} <> {PLACES - 1}),
messages AS (SELECT k, unnest(range(1, len(m) + 1)) AS turn, unnest(m) AS m FROM (SELECT k, string_split(chat, '<|im_start|>')[2:] AS m FROM chats)),
turns_in AS (SELECT {{'chat': k, 'turn': turn, 'role': split_part(m, chr(10), 1)}} AS k, '<|im_start|>' || m AS text FROM messages),
{sql_encoded('turns_in')}, {sql_chats_laid_out(SAMPLE_LENGTH, 'k.chat', 'k.turn', 'k.role')}, {sql_fed('chats')}""")
def sft_feed(spark, sf_dir):
    data, out = fresh_path(spark, "chats.jsonl"), fresh_path(spark, "feed")
    line = chat_record(F.col("question"), F.col("answer"), F.col("conv_id"))
    fx.jsonl_folder(questions(spark, sf_dir), data, line, "conv_id")
    training.sft_feed(spark, data, trained(spark, sf_dir), out, SAMPLE_LENGTH, RANKS, 1, SEED)
    return _fed(spark, out)


def _fed(spark, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.select("epoch", "rank", "place", "row", shown(F.col("input_ids")).alias("input_ids"),
                       shown(F.col("labels")).alias("labels"))
