import json
import random
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from textmill.functions import text as X

FEW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 　   ​"
# Characters every Unicode version in use agrees on; the JVM's tables are older than Python's.
SETTLED = st.characters(exclude_categories=["Cs"]).filter(lambda c: unicodedata.ucd_3_2_0.category(c) != "Cn")
TEXTS = st.lists(
    st.text(st.one_of(st.sampled_from(BLANKS), st.sampled_from("ab\"\\é中𐀀'1."), SETTLED), max_size=30),
    min_size=20, max_size=60,
)


def column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [r.x for r in df.select("i", expression(F.col("s")).alias("x")).orderBy("i").collect()]


CLEAN = {
    "": "", " \t ": "", "one": "one", " one \n": "one", "a\r\nb": "a\nb", "a\rb\r": "a\nb", "a\n\n \n\tb  c ": "a\nb  c",
    "\u3000a\xa0\n\u2003\x85b": "a\nb", "a\x1cb": "a\x1cb", "\u200ba": "\u200ba", "\n\r\n\r": "", "é \r\n中": "é\n中",
}


def test_clean(spark):
    assert column(spark, list(CLEAN), X.clean_text) == list(CLEAN.values())


def test_spaces_are_those_of_python():
    assert {chr(c) for c in range(0x110000) if chr(c).isspace()} == set(X.SPACES)


@FEW
@given(TEXTS)
def test_strip_clean_and_sizes(spark, texts):
    assert column(spark, texts, X.strip) == [t.strip() for t in texts]
    clean = column(spark, texts, X.clean_text)
    assert ["".join(c.split()) for c in clean] == ["".join(t.split()) for t in texts]  # nothing but blanks goes
    assert all(line and line == line.strip() for c in clean if c for line in c.split("\n")) and not any("\r" in c for c in clean)
    assert column(spark, clean, X.clean_text) == clean
    assert column(spark, texts, X.char_length) == [len(t) for t in texts]
    lines = [json.dumps({"text": t}, ensure_ascii=False) + "\n" for t in texts]
    assert column(spark, texts, X.row_bytes) == [len(line.encode()) for line in lines]
    got = column(spark, texts, X.json_row)
    assert [json.loads(g) for g in got] == [{"text": t} for t in texts]
    assert [g.lower() for g in got] == [line[:-1].lower() for line in lines]


@FEW
@given(TEXTS)
def test_nfkc_and_pretokens(spark, texts):
    normal = [unicodedata.normalize("NFKC", t) for t in texts]
    assert column(spark, texts, X.nfkc) == normal
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    pieces = column(spark, normal, X.pretokens)
    assert ["".join(p) for p in pieces] == normal
    assert [[len(w.encode()) for w in p] for p in pieces] == [
        [len(w) for w, _ in split.pre_tokenize_str(t)] for t in normal]


def test_stable_characters_do_not_change():
    import regex

    stable = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and regex.match(X.NFKC_STABLE_TEXT.replace(r"\z", r"\Z"), chr(c))]
    assert len(stable) > 27_000
    assert all(unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c) for c in stable)
    rng = random.Random(1)
    rng.shuffle(stable)
    assert unicodedata.normalize("NFKC", "".join(stable)) == "".join(stable)


SIZES = {"": 0, "0": 0, "17": 17, " 5GB ": 5 << 30, "1.5k": 1536, "0.3KB": 307, "2 mb": 2 << 20, "7M": 7 << 20, "-1K": -1024}


def test_sizes(spark):
    assert column(spark, list(SIZES), X.size_bytes) == list(SIZES.values())
    assert [X.parse_size(s) for s in SIZES] == list(SIZES.values())
    for bad in ("5TB", "x", "1.5"):
        with pytest.raises(ValueError):
            X.parse_size(bad)
        with pytest.raises(Exception):
            column(spark, [bad], X.size_bytes)


VALUES = ["1", "-7", "1.0", "1.50", "0.1", "1e5", "1e20", "1.5e20", "1e16", "1e15", "123456789.25", "1e-5", "1e-4",
          "0.00025", "12345678.5", "1e100", "1.25e-7", "-2.5e17", "true", "false", "null", '"x y"', '""',
          "12345678901234567890123", "9007199254740993", "1e400"]


def test_python_str(spark):
    lines = [f'{{"text": {v}}}' for v in VALUES] + ["{}"]
    got = column(spark, lines, lambda s: X.python_str(X.variant_field(F.parse_json(s), "text")))
    assert got == [str(json.loads(line).get("text", "")) for line in lines]


RECORDS = [
    {"text": " a "}, {"text": " ", "content": "b"}, {"text": 1, "data": "c"}, {"正文": "d", "data": []},
    {"title": " t ", "output": "o", "question": "", "desc": "　"}, {"text": None}, {}, [], [{"text": "x"}], 5, None, True,
    "bare", " ", {"text": {"text": "x"}}, {"answer": "a", "title": "b", "input": "c", "instruction": "d", "chinese": "e"},
]


def test_record_text(spark):
    got = column(spark, [json.dumps(r) for r in RECORDS], lambda s: X.record_text(F.parse_json(s)))
    assert got == [" a ", "b", "c", "d", "t\no", "", "", "", "", "", "", "", "bare", " ", "", "b\na\ne\nd\nc"]


def test_cleaning_runs_on_a_stream(spark, docs, tmp_path):
    """Row-wise expressions are plain columns, so they serve a streaming table as well."""
    docs.select("text").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("text string").parquet(str(tmp_path / "in"))
    out = stream.select(X.clean_text(F.col("text")).alias("t")).where(X.char_length(F.col("t")) >= 80)
    query = out.writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).start()
    query.awaitTermination(60)
    at_once = docs.select(X.clean_text(F.col("text")).alias("t")).where(X.char_length(F.col("t")) >= 80)
    assert sorted(r.t for r in spark.table("cleaned").collect()) == sorted(r.t for r in at_once.collect())
