import json
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, trainers

from textmill.functions.chat import render_chat
from textmill.operators import encode as E
from textmill.operators import vocab as V


def library(ours, texts, size):
    """The engine's own tokenizer file, trained anew by the public library."""
    tok = Tokenizer.from_str(ours.tokenizer_json())
    tok.train_from_iterator(texts, trainers.BpeTrainer(
        vocab_size=size, special_tokens=list(V.SPECIAL_TOKENS), min_frequency=2, show_progress=False))
    return tok


def table(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


RUNS = ["aaaa aaa aa aaaaaaa", "abab ababab ba bab", "xx xxx xxxx xyxyx", "中文没有空格，所以一句话就是一个词。", "中文没有空格。",
        "ﬁne ½ … ＡＢＣ", "don't we'll they've", "   tabs\t\tand\n\nlines  ", "aabbaabb abba aab bba"] * 2


def random_words(seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab c") for _ in range(rng.randint(5, 60))) for _ in range(30)]


@pytest.mark.parametrize("texts,size", [(RUNS, 200), (random_words(1), 90), (random_words(2), 60)])
def test_training_equals_the_library(spark, texts, size):
    ours = V.train_bpe(V.pretoken_freq(table(spark, texts)), size)
    theirs = json.loads(library(ours, texts, size).to_str())["model"]
    assert ours.tokens == sorted(theirs["vocab"], key=theirs["vocab"].get)
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in theirs["merges"]]
    assert [(ours.tokens[a], ours.tokens[b]) for a, b, _ in ours.merges] == merges


@pytest.fixture(scope="module")
def trained(spark, docs):
    few = docs.where("doc_id < 60")
    ours = V.train_bpe(V.pretoken_freq(few), 260)
    return ours, library(ours, [r.text for r in few.orderBy("doc_id").collect()], 260)


def test_training_on_documents(spark, trained, monkeypatch, docs):
    ours, theirs = trained
    assert theirs.get_vocab() == {t: i for i, t in enumerate(ours.tokens)}
    monkeypatch.setattr(V, "STAGE_AFTER", 8)  # many rewrites of the word table change nothing
    again = V.train_bpe(V.pretoken_freq(docs.where("doc_id < 60")), 140)
    assert again.merges == ours.merges[:len(again.merges)] and len(again.tokens) == 140


TEXTS = ["", " ", "plain words", "Grüße, señor! l'été", "汉字 never seen", "a</s>b <|im_start|>x<unk>", "＜s＞ </s", "tail  \n ",
         "z" * 3000, "12 345 ½", "emoji 😀"]


@pytest.mark.parametrize("limit", [None, 1, 7])
def test_encode_equals_the_library(spark, trained, limit):
    ours, theirs = trained
    enc = E.encoder(spark, ours)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").withColumn("ids", enc(F.col("t"), limit))
    got = [r.ids for r in df.orderBy("i").collect()]
    assert got == [theirs.encode(t, add_special_tokens=False).ids[:limit] for t in TEXTS]
    same = Tokenizer.from_str(ours.tokenizer_json())
    assert [same.encode(t, add_special_tokens=False).ids for t in TEXTS] == [
        theirs.encode(t, add_special_tokens=False).ids for t in TEXTS]


def test_specials_as_plain_text(spark, trained):
    enc = E.encoder(spark, trained[0], "text")
    ids = table(spark, ["a</s>b"]).select(enc(F.col("text")).alias("i")).first().i
    assert not set(ids) & set(range(1, 5))


def test_decode_equals_the_library(spark, trained):
    ours, theirs = trained
    rng = random.Random(3)
    lists = [[rng.randrange(len(ours.tokens)) for _ in range(rng.randint(0, 30))] for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, ids array<int>")
    got = [r.t for r in df.select("i", E.decode(F.col("ids"), ours).alias("t")).orderBy("i").collect()]
    assert got == [theirs.decode(ids, skip_special_tokens=True) for ids in lists]


def test_rounds_read_what_they_need(spark, trained, docs):
    """Several merges a round, and after the first scan of all words only words that hold a pair that is tried."""
    few = docs.where("doc_id < 60")
    vocab = V.train_bpe(V.pretoken_freq(few), 260)
    words = V.pretoken_freq(few).where("octet_length(word) > 1").count()
    first, *later = vocab.rounds
    assert first == V.Round(0, words, True) and sum(r.merges for r in later if not r.whole) >= len(vocab.merges) - 1
    assert len(later) < len(vocab.merges) / 2 and all(0 < r.merges <= V.ROUND_MERGES[1] for r in later if not r.whole)
    assert min(r.rows for r in later) < words


def test_the_first_rounds_write_no_index(spark, trained, docs, monkeypatch):
    """A word goes once to a round, not once for each of its pairs; with an index the merges are the same."""
    few = V.pretoken_freq(docs.where("doc_id < 60"))
    built = []
    write = V.WordIndex._write_index
    monkeypatch.setattr(V.WordIndex, "_write_index", lambda self, *a: built.append(a[1]) or write(self, *a))
    scanned = V.train_bpe(few, 120)
    assert not built and {r.rows for r in scanned.rounds if not r.whole} <= {r.rows for r in scanned.rounds if r.whole}
    monkeypatch.setattr(V, "IDLE_SCANS", 0)
    indexed = V.train_bpe(few, 120)
    assert built and indexed.merges == scanned.merges == trained[0].merges[:len(scanned.merges)]


def test_places_of_a_repeated_symbol():
    """Differences of pair counts are those of all pairs before and after, runs of one symbol included."""
    turn, sums = random.Random(5), V._Sums()
    words = ["".join(turn.choice("aab") for _ in range(turn.randint(2, 9))) for _ in range(200)] + ["aaaa", "aaa", "b"]
    freq = np.arange(1, len(words) + 1)
    merges = [("aa", "\U00010005"), ("\U00010005b", "\U00010006"), ("\U00010005\U00010005", "\U00010007")]
    assert V._merged("\n".join(words), freq, merges, sums) == sum("aa" in w for w in words)
    got = {(r["step"], r["pair"]): r["n"] for r in sums.batch().to_pylist()}
    wanted = Counter()
    for step, (pair, char) in enumerate(merges):
        for i, w in enumerate(words):
            new = w.replace(pair, char)
            if new != w:
                for x, sign in ((w, -1), (new, 1)):
                    for p in zip(x, x[1:]):
                        wanted[step, "".join(p)] += sign * int(freq[i])
            words[i] = new
    assert got == {k: n for k, n in wanted.items() if n}


def test_stretches_between_blanks(trained):
    """Cutting at blanks before splitting into words gives the same ids, whatever white space stands around."""
    ours, theirs = trained
    words, turn = E._WordEncoder(ours.tokens, ours.merges, True), random.Random(6)
    parts = [*" \n\t\u3000\x1cab'st1\u00e9", "  ", " \n", "\n ", "\u00a0", "'s", "the ", "  in", "x" * 60]
    for _ in range(3_000):
        text = "".join(turn.choice(parts) for _ in range(turn.randint(0, 14)))
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert all(words.text(text, limit) == ids[:limit] for limit in (None, 1, 4, 300)), repr(text)


def test_ids_leave_in_slices(spark, trained, monkeypatch):
    """A worker hands on the ids of a few rows at a time, and remembers few words; results do not depend on it."""
    monkeypatch.setattr(E, "_SLICE_BYTES", 100)
    array = pa.array(["x" * 30, None, ""] * 50)
    parts = list(E._slices(array))
    assert len(parts) > 10 and pa.concat_arrays(parts) == array and max(p.nbytes for p in parts) < 300
    assert E._CACHE_WORDS <= 150_000


def test_decode_leaves_out_what_is_no_token(spark, trained):
    ours = trained[0]
    rows = [([7, None, 8],), ([-1, 7, 99_999, 8],), (None,), ([],), ([1, 7, 8, 2],)]
    got = [r.t for r in spark.createDataFrame(rows, "ids array<int>").select(E.decode(F.col("ids"), ours).alias("t")).collect()]
    one = ours.tokens[7] + ours.tokens[8]
    assert got == [one, one, None, "", one]


def test_counts_beyond_those_followed(spark, trained, docs, monkeypatch):
    """With few pairs followed, and a small index, training counts anew and merges the same."""
    monkeypatch.setattr(V, "FOLLOWED_PAIRS", 12)
    again = V.train_bpe(V.pretoken_freq(docs.where("doc_id < 60")), 150)
    assert again.merges == trained[0].merges[:len(again.merges)] and len(again.tokens) == 150
    assert sum(r.whole for r in again.rounds) > 2


def test_save_and_load(spark, trained, tmp_path):
    V.save_vocabulary(spark, trained[0], str(tmp_path / "v"))
    assert V.load_vocabulary(spark, str(tmp_path / "v")) == trained[0]
    text = spark.read.text(str(tmp_path / "v/tokenizer_json"), wholetext=True).first().value
    assert Tokenizer.from_str(text).get_vocab_size() == 260


def check_document(ids, inputs, labels, length):
    """What every document sample has: begin, the head of the text, end marks, labels one place ahead."""
    assert len(inputs) == len(labels) == length and inputs[0] == 1
    assert all(y in (-100, x) and (y == -100) == (x == 2) for x, y in zip(inputs[1:], labels))
    body = inputs[1:]
    while body and body[-1] == 2:
        body = body[:-1]
    assert body == ids[: len(body)] and (len(body) == len(ids) or len(body) >= length - 2)


def check_chat(turns, inputs, labels, length):
    """Labels are the next ids inside assistant turns, and the end mark of a chat that fits."""
    assert len(inputs) == len(labels) == length and inputs[0] == 1
    place = 1
    for role, part in turns:
        for x in part[: max(0, length - place)]:
            assert inputs[place] == x and labels[place - 1] == (x if role == "assistant" else -100)
            place += 1
    rest = length - place
    assert inputs[place:] == [2] * rest and (not rest or labels[place - 1 :] == [2] + [-100] * rest)


# length, ids: inputs and labels
DOCUMENTS = [
    (1, [], [1], [-100]), (1, [7], [1], [7]), (1, [7, 8], [1], [7]),
    (2, [], [1, 2], [-100, -100]), (2, [7, 8], [1, 7], [7, -100]),
    (3, [7], [1, 7, 2], [7, -100, -100]), (3, [7, 8], [1, 7, 2], [7, -100, -100]),
    (4, [], [1, 2, 2, 2], [-100] * 4), (4, [7, 8], [1, 7, 8, 2], [7, 8, -100, -100]),
    (4, [5, 6, 7, 8, 9], [1, 5, 6, 2], [5, 6, -100, -100]),
    (6, [2, 3, 2], [1, 2, 3, 2, 2, 2], [-100, 3, -100, -100, -100, -100]),
    (6, [9, 9, 9, 9], [1, 9, 9, 9, 9, 2], [9, 9, 9, 9, -100, -100]),
]
CHATS = [
    (1, [], [1], [2]), (1, [("assistant", [7, 8])], [1], [7]), (1, [("user", [7, 8])], [1], [-100]),
    (3, [], [1, 2, 2], [2, -100, -100]), (3, [("user", [5, 6])], [1, 5, 6], [-100, -100, 2]),
    (4, [("user", [5] * 30), ("assistant", [6])], [1, 5, 5, 5], [-100] * 4),
    (4, [("assistant", [5, 6, 7, 8, 9])], [1, 5, 6, 7], [5, 6, 7, 8]),
    (8, [("system", [5]), ("user", [6, 6]), ("assistant", [7, 8, 9])], [1, 5, 6, 6, 7, 8, 9, 2], [-100, -100, -100, 7, 8, 9, 2, -100]),
]


@pytest.mark.parametrize("length", [1, 2, 3, 4, 6, 8])
def test_layouts(spark, length):
    cases = [c[1:] for c in DOCUMENTS if c[0] == length]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, ids array<int>")
    got = [tuple(r.s) for r in df.select("i", E.pretrain_sample(F.col("ids"), length).alias("s")).orderBy("i").collect()]
    assert got == [tuple(c[1:]) for c in cases]
    cases = [c[1:] for c in CHATS if c[0] == length]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, m array<struct<role:string,ids:array<int>>>")
    got = [tuple(r.s) for r in df.select("i", E.sft_sample(F.col("m"), length).alias("s")).orderBy("i").collect()]
    assert got == [tuple(c[1:]) for c in cases]


@pytest.mark.parametrize("length", [1, 5, 40, 300])
def test_chats_from_turns_and_from_arrays(spark, trained, length):
    """A chat with far more turns than fit gives the sample its first turns give."""
    ours, theirs = trained
    chats = {c: [(r, f"turn {t} of {c}") for t, r in enumerate(["system"] + ["user", "assistant"] * n)]
             for c, n in ((0, 1), (1, 200), (2, 3))}
    turns = spark.createDataFrame([(c, t * 3, *m) for c, ms in chats.items() for t, m in enumerate(ms)],
                                  "conv_id int, turn int, role string, text string").repartition(7)
    enc = E.encoder(spark, ours)
    got = {r.conv_id: (r.input_ids, r.labels) for r in E.encode_turns(turns, enc, length).collect()}
    for c, ms in chats.items():
        check_chat([(r, theirs.encode(f"<|im_start|>{r}\n{x}<|im_end|>\n", add_special_tokens=False).ids) for r, x in ms], *got[c], length)
    wanted = got
    arrays = spark.createDataFrame([(c, ms) for c, ms in chats.items()],
                                   "conv_id int, messages array<struct<role:string,content:string>>")
    got = {r.conv_id: (r.input_ids, r.labels) for r in E.encode_chats(arrays, enc, length).collect()}
    assert got == wanted
    text = arrays.where("conv_id = 0").select(render_chat(F.col("messages"), True).alias("t")).first().t
    assert text.endswith("turn 2 of 0<|im_end|>\n<|im_start|>assistant\n")


def test_long_samples_of_a_huge_chat(spark, monkeypatch):
    """Above the limit that Spark pushes down, the first turns are found in buckets; the result is the same."""
    monkeypatch.setattr("textmill.operators.order.BUCKET_KEYS", 500)
    turns = spark.range(30_000).selectExpr("CAST(0 AS INT) conv_id", "CAST(29999 - id AS INT) turn", "'user' role", "'x' text")
    few = spark.createDataFrame([(1, 5, "user", "a"), (1, None, "system", "b"), (None, 1, "user", "c"), (2, -7, "user", "d")],
                                "conv_id int, turn int, role string, text string")
    rows = turns.unionByName(few).repartition(5)
    long = E.first_turns(rows, "conv_id", "turn", 4_200)
    limit = E.turns_in_sample(4_200)
    assert limit > 1_000 and "hashpartitioning(conv_id#" in long._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, long.collect()), key=str)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "100000")
    try:
        assert got == sorted(map(tuple, E.first_turns(rows, "conv_id", "turn", 4_200).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert len(got) == limit + 4 and {t[1] for t in got if t[0] == 0} == set(range(limit))
    # No task sorts the chat as one group: the window that numbers its turns is inside a bucket.
    assert "windowspecdefinition(conv_id" in long._jdf.queryExecution().optimizedPlan().toString() and "_b0#" in long._jdf.queryExecution().optimizedPlan().toString()
