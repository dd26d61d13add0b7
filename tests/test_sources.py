import json

import pytest
from pyspark.sql import functions as F

from textmill.operators.convert import convert_text
from textmill.operators.order import block_sequence
from textmill.sources import files, samples
from textmill.workspace import stage


def put(folder, files_):
    for name, content in files_.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())


def in_order(df, column="raw"):
    keys = [c for c in files.ORDER[:-1] if c in df.columns]
    return [r[column] for r in block_sequence(stage(df, "test"), keys, "pos").orderBy("seq").collect()]


def test_tree_in_reading_order(spark, tmp_path):
    put(tmp_path, {
        "b/x.jsonl": '{"text": "l1"}\n\n{"text": "l2"}\n', "a/wiki_1.jsonl": '{"text": "both"}\n',
        "z.json": '[{"text": "j1"}, "j2", 3]', "t +%.txt": "t1\r\nt2\rt3\n", "wiki_0": '{"text": "w"}\n', "a b/c.txt": "t0",
        "d/wiki_9.txt": "line", "ignored.csv": "no", "d/.hidden.txt": "hidden", "d/_hidden.txt": "hidden",
    })
    spark.createDataFrame([("p",)], "content string").write.parquet(str(tmp_path / "rows"))
    got = in_order(files.read_corpus(spark, [str(tmp_path), str(tmp_path / "none"), str(tmp_path / "b/x.jsonl")]))
    assert got == ["both", "l1", "l2", "j1", "j2", "", "t0", "line", "t1", "t2", "t3", "p",
                   "both", "line", "w", "l1", "l2"]
    listed = {(r.file_class, "/".join(r.file_parts)[-10:]) for r in files.input_files(spark, str(tmp_path)).collect()}
    assert (0, "iki_1.jsonl"[-10:]) in listed and (4, "iki_1.jsonl"[-10:]) in listed and len(listed) == 10


def test_names_with_pattern_characters(spark, tmp_path):
    put(tmp_path, {"g[1]/a{x}.jsonl": '{"text": "l"}\n', "g[1]/w*/wiki_0": '{"text": "w"}\n', "g[1]/t?.txt": "t\n", "g1/no.txt": "no"})
    for name, df in (("p[a]", [("p", 1)]), ("p{b}", [(2, 3)])):
        spark.createDataFrame(df, ["content", "n"]).coalesce(1).write.parquet(str(tmp_path / "g[1]" / name))
    assert sorted(r.raw for r in files.read_corpus(spark, [str(tmp_path / "g[1]")]).collect()) == ["", "l", "p", "t", "w"]
    assert [r.raw for r in files.read_corpus(spark, [str(tmp_path / "g[1]/a{x}.jsonl")]).collect()] == ["l"]
    assert [r.raw for r in files.wiki_shards(spark, str(tmp_path / "g[1]")).collect()] == ["w"]
    assert sorted(r.text for r in samples.tokenizer_texts(spark, str(tmp_path / "g[1]")).collect()) == ["l", "t"]
    assert [r.text for r in samples.pretrain_samples(spark, str(tmp_path / "g[1]/t?.txt")).collect()] == ["t"]


def test_line_order_over_many_blocks(spark, tmp_path):
    lines = {name: [f"{name}{i} " + "x" * (i % 50) for i in range(3000)] for name in "abc"}
    put(tmp_path, {f"{n}.txt": "\n".join(v) for n, v in lines.items()})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = files.text_lines(spark, str(tmp_path), "*.txt")
        assert df.rdd.getNumPartitions() > 5
        assert in_order(df) == lines["a"] + lines["b"] + lines["c"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


LINES = ['{"text": "ok"}', "", "  　", '{"text": "cut', '{"text": "x"} tail', '{"text": "x"}{"text": "y"}', "1,2", '"bare"',
         '{"text": "first", "text": "last"}', '{"text": "n", "v": NaN}', "\xa0{\"text\": \"padded\"} ", "[1]", "null", "7",
         '{"text": "x"},', "{'text': 'x'}", '{"text": "a\tb"}', '{"text": "\\u00e9\\n"}']


def test_json_lines_follow_python(spark, tmp_path):
    put(tmp_path, {"a.jsonl": "\n".join(LINES)})
    wanted = []
    for line in LINES:
        try:
            record = json.loads(line.strip())
        except ValueError:
            continue
        wanted.append(record.get("text", "") if isinstance(record, dict) else record if isinstance(record, str) else "")
    assert in_order(files.json_lines(spark, str(tmp_path / "a.jsonl"))) == wanted


def test_a_record_over_the_parser_limit_is_kept(spark, tmp_path):
    put(tmp_path, {"a.jsonl": json.dumps({"content": "y" * 21_000_000}) + '\n{"text": "z"}\n'})
    got = files.json_lines(spark, str(tmp_path / "a.jsonl")).select(F.length("raw").alias("n")).collect()
    assert sorted(r.n for r in got) == [1, 21_000_000]
    strict = files.strict_json_lines(spark, str(tmp_path / "a.jsonl")).select(F.length("raw").alias("n")).collect()
    assert sorted(r.n for r in strict) == [0, 1]


def test_strict_lines(spark, tmp_path):
    good = ['{"text": 1.0}', '{"text": null}', "{}", '{"text": [1, 2]}', '{"text": " s "}', '{"text": true, "v": NaN}']
    put(tmp_path, {"wiki_a": "\n".join(good), "x/wiki_b": '{"text": "b"}', "other": "not json"})
    assert in_order(files.wiki_shards(spark, str(tmp_path))) == ["1.0", "None", "", "[1, 2]", " s ", "True", "b"]
    put(tmp_path, {"wiki_c": '{"text": "cut'})
    with pytest.raises(Exception, match="malformed JSON line"):
        files.wiki_shards(spark, str(tmp_path)).collect()
    for i, bad in enumerate(("5", '"str"', "null", "[1]", '{"text": 1} tail', '{"v": NaN} x')):
        put(tmp_path, {f"bad{i}/wiki_a": bad})
        with pytest.raises(Exception, match="malformed JSON line"):
            files.wiki_shards(spark, str(tmp_path / f"bad{i}")).collect()


ENVELOPES = {
    "a": ('[{"text": "1"}, "2", null, [3]]', ["1", "2", "", ""]),
    "b": ('{"data": [{"text": "1"}], "train": ["no"]}', ["1"]),
    "c": ('{"data": "whole", "text": " "}', ["whole"]),
    "d": ('{"rows": {"x": 1}, "documents": ["d"], "train": null}', ["d"]),
    "e": ('{"text": "solo"}', ["solo"]),
    "f": ('{"data": []}', []),
    "g": ("3", []), "h": ('"text"', []), "i": (' \n[{"text": "x", "text": "y"}]\n', ["y"]), "j": ("[]", []), "k": ("{}", [""]),
    "l": ('[{"text": "x"}, NaN]', ["x", ""]), "m": ('[NaN, {"text": "x"}]', ["", "x"]), "n": ('{"data": [{"text": "q", "v": NaN}, 1]}', ["q", ""]),
    "o": ('{"data": "whole", "v": Infinity}', ["whole"]), "p": ("NaN", []), "q": ('[{"content": "x", "content": "y"}]', ["y"]),
}


def test_json_files(spark, tmp_path):
    put(tmp_path, {f"{n}.json": c for n, (c, _) in ENVELOPES.items()})
    got = in_order(files.json_file(spark, str(tmp_path), "*.json"))
    assert got == [t for _, texts in ENVELOPES.values() for t in texts]
    for bad in ('[{"text": "x"}', '[1] x', "{", "nope", "3 tail", '"x" y', "[NaN] 1", "{} {}"):
        put(tmp_path, {"bad/x.json": bad})
        with pytest.raises(Exception, match="malformed JSON file"):
            files.json_file(spark, str(tmp_path / "bad"), "*.json").collect()


def test_json_file_over_the_size_of_one_value(spark, tmp_path):
    put(tmp_path, {"big.json": json.dumps([{"text": "x" * 1_000_000, "n": i} for i in range(40)])})
    put(tmp_path, {"long.json": json.dumps([{"text": "y" * 21_000_000}, {"text": "z"}])})
    got = files.json_file(spark, str(tmp_path / "long.json")).select("pos", F.length("raw").alias("n")).orderBy("pos").collect()
    assert [r.n for r in got] == [21_000_000, 1]
    rows = files.json_file(spark, str(tmp_path / "big.json")).agg(F.count("*"), F.sum(F.length("raw"))).first()
    assert tuple(rows) == (40, 40_000_000)


def test_parquet_with_different_schemas(spark, tmp_path):
    spark.createDataFrame([("a", 1), (None, 2)], "text string, n int").coalesce(1).write.parquet(str(tmp_path / "1"))
    spark.createDataFrame([(5, "b")], "text int, answer string").write.parquet(str(tmp_path / "2"))
    spark.createDataFrame([(b"x", " c ", "d")], "data binary, output string, title string").write.parquet(str(tmp_path / "3"))
    assert in_order(files.parquet_rows(spark, str(tmp_path), "*.parquet")) == ["a", "", "b", "d\nc"]


def test_samples(spark, tmp_path):
    put(tmp_path, {"t/a.txt": " x \n\n y\n", "t/b.jsonl": '{"text": " z "}\n{"text": " "}\n{"text": 5}\n', "t/c.json": "[1]", "t/d/e.txt": "deep"})
    assert [r.text for r in samples.pretrain_samples(spark, str(tmp_path / "t/a.txt")).collect()] == ["x", "y"]
    assert [r.text for r in samples.pretrain_samples(spark, str(tmp_path / "t/b.jsonl")).collect()] == ["z", "5"]
    assert sorted(r.text for r in samples.tokenizer_texts(spark, str(tmp_path / "t")).collect()) == ["5", "x", "y", "z"]
    chats = [
        {"messages": [{"role": "user", "content": "q"}]}, {"messages": []}, {"messages": None, "instruction": "x"},
        {"instruction": " i ", "input": " in ", "output": "o"}, {"instruction": None, "human": "h", "assistant": "a"},
        {"human": "h", "input": "", "output": 2.5}, {},
    ]
    put(tmp_path, {"c.txt": "\n".join(json.dumps(c) for c in chats)})
    got = samples.chat_samples(spark, str(tmp_path / "c.txt")).orderBy("pos").collect()
    system = ("system", "你是一个AI助手。")
    assert [[tuple(m) for m in r.messages] for r in got] == [
        [("user", "q")], [system, ("user", "i\n\n输入：\nin"), ("assistant", "o")],
        [system, ("user", "None"), ("assistant", "a")], [system, ("user", "h"), ("assistant", "2.5")],
        [system, ("user", ""), ("assistant", "")]]


CONTENTS = [  # content as JSON and as the sample has it
    ("null", "None"), ("1.0", "1.0"), ("true", "True"), ("false", "False"), ("2", "2"), ("1e20", "1e+20"), ("NaN", "nan"), ('" s "', " s "), ('""', "")]


def test_chat_contents_follow_python(spark, tmp_path):
    lines = [f'{{"messages": [{{"role": "user", "content": {c}}}]}}' for c, _ in CONTENTS]
    lines += ['{"human": "first", "human": "last", "output": NaN}', json.dumps({"instruction": "q" * 20_100_000})]
    put(tmp_path, {"c.jsonl": "\n".join(lines)})
    got = samples.chat_samples(spark, str(tmp_path / "c.jsonl")).orderBy("pos").collect()
    assert [tuple(r.messages[0]) for r in got[: len(CONTENTS)]] == [("user", s) for _, s in CONTENTS]
    assert [m.content for m in got[-2].messages[1:]] == ["last", "nan"]
    assert [len(m.content) for m in got[-1].messages[1:]] == [20_100_000, 0]


def test_broken_chats_fail(spark, tmp_path):
    for i, bad in enumerate((
            '{"instruction": "i"} tail', '{"instruction": "i"}{"a": 1}', "[1]", "5", '"s"', "null", '{"messages": "abc"}',
            '{"messages": {"a": 1}}', '{"messages": 7}', '{"messages": [5]}', '{"messages": [{"role": "user"}]}',
            '{"messages": [{"content": NaN}]}', '{"messages": true}')):
        put(tmp_path, {f"{i}.jsonl": bad})
        with pytest.raises(Exception, match="not a chat sample"):
            samples.chat_samples(spark, str(tmp_path / f"{i}.jsonl")).collect()
    for i, none in enumerate(("[]", "{}", '""', "0", "0.0", "false", "null")):
        put(tmp_path, {f"n{i}.jsonl": f'{{"messages": {none}, "instruction": "x"}}'})
        assert samples.chat_samples(spark, str(tmp_path / f"n{i}.jsonl")).collect() == []


def leftmost_longest(text, table):
    out, i = "", 0
    while i < len(text):
        hit = max((s for s in table if text.startswith(s, i)), key=len, default=None)
        out += text[i] if hit is None else table[hit]
        i += 1 if hit is None else len(hit)
    return out


@pytest.mark.parametrize("extra", [0, 1500])
def test_conversion(spark, extra):
    table = {"漢": "汉", "語": "语", "皇后": "皇后", "后來": "后来", "來": "来", "乾": "干", "乾坤": "乾坤", "a.": "[dot]", "x": "", "é": "ee", "同": "同"}
    table |= {f"词{i}": f"w{i}" for i in range(extra)}
    texts = ["漢語皇后來乾坤乾", "a.b a.a xé\n同", "", "皇后后來來", "词12词1词1499乾", "𠀀漢" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.x for r in df.select("i", convert_text(F.col("t"), table).alias("x")).orderBy("i").collect()]
    assert got == [leftmost_longest(t, table) for t in texts]


def leftmost_longest(text: str, table: dict) -> str:
    out, at = [], 0
    while at < len(text):
        n = next((n for n in range(min(12, len(text) - at), 0, -1) if text[at:at + n] in table), 0)
        out.append(table[text[at:at + n]] if n else text[at])
        at += max(n, 1)
    return "".join(out)


def test_dictionary_of_200_000_entries(spark):
    """A table of any size, with repeated and null entries, converts as the entries that occur would alone."""
    import random

    from textmill.operators.convert import convert, load_dictionary

    turn = random.Random(8)
    small = {"".join(turn.choice("abcdé") for _ in range(turn.randint(1, 6))): f"<{i}>" for i in range(300)}
    texts = ["", None, "abcdé" * 20, "é", "no entry here: xyz"] + ["".join(turn.choice("abcdéxy ") for _ in range(80)) for _ in range(40)]
    large = spark.range(200_000).selectExpr("concat('a#', id) src", "'never' dst")
    more = [(s, d) for s, d in small.items()] + [(s, "~later") for s in small] + [(None, "x"), ("b", None), ("", "y")]
    table = large.unionByName(spark.createDataFrame(more, "src string, dst string"))
    wanted = dict(small)
    loaded = load_dictionary(table)
    assert len(loaded) == 200_000 + len(small) and {s: loaded[s] for s in small} == wanted
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.t for r in convert(df, "t", table).orderBy("i").collect()]
    assert got == [None if t is None else leftmost_longest(t, wanted) for t in texts]
    alone = [r.t for r in convert(df, "t", wanted).orderBy("i").collect()]
    assert alone == got


@pytest.mark.parametrize("sent", [40, 5_000])
def test_a_large_dictionary_stays_a_table(spark, monkeypatch, sent):
    """Workers get only entries that stand in a text, or, where these are many, each text the entries in it."""
    import random

    from textmill.operators import convert as K

    loaded = []
    monkeypatch.setattr(K, "SENT_ENTRIES", sent)
    monkeypatch.setattr(K, "MAX_BYTES", 20_000)  # far less than the whole table has
    monkeypatch.setattr(K, "load_dictionary", lambda table, load=K.load_dictionary: loaded.append(load(table)) or loaded[-1])
    turn = random.Random(8)
    small = {"".join(turn.choice("abcdé\U0001F600") for _ in range(turn.randint(1, 6))): f"<{i}>" for i in range(300)}
    texts = ["", None, "abcdé" * 20, "é", "no entry: xyz", "xyz"] + ["".join(turn.choice("abcdéxy \U0001F600") for _ in range(80)) for _ in range(40)]
    large = spark.range(20_000).selectExpr("concat(array('a', 'é', '\u0001')[id % 3], '#', id) src", "'never' dst")
    table = large.unionByName(spark.createDataFrame([*small.items(), *((s, "~later") for s in small), (None, "x"), ("b", None), ("", "y")], "src string, dst string"))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts) for _ in range(2)], "_row int, t string").repartition(3)
    got = [tuple(r) for r in K.convert(df, "t", table).orderBy("_row").collect()]
    assert got == [(i, None if t is None else leftmost_longest(t, small)) for i, t in enumerate(texts) for _ in range(2)]
    assert [len(d) <= len(small) for d in loaded] == [True] * (sent == 5_000)


VALUES = ['{"a": 1}', "[true, null]", '{"b": {"c": [1.5, "x\'y", {}]}}', "-0.0", "0.0", "-0", "-0e5", '"-0.0"', "null", "12345678901234567890123"]


def test_nested_values_print_alike_in_both_parsers(spark, tmp_path):
    """A field that has nothing to do with the text does not decide how it prints."""
    lines = [f'{{"text": {v}{rest}}}' for v in VALUES for rest in ("", ', "other": NaN', ', "z": "-0"')]
    (tmp_path / "n.jsonl").write_text("\n".join(lines))
    got = files.strict_json_lines(spark, str(tmp_path / "n.jsonl")).orderBy("pos").collect()
    assert [r.raw for r in got] == [str(json.loads(line)["text"]) for line in lines]
    chats = [f'{{"instruction": {v}, "output": "x"{rest}}}' for v in VALUES for rest in ("", ', "other": NaN')]
    chats += [f'{{"messages": [{{"role": "user", "content": {v}}}]{rest}}}' for v in VALUES for rest in ("", ', "other": NaN')]
    (tmp_path / "c.jsonl").write_text("\n".join(chats))
    got = [m.content for r in samples.chat_samples(spark, str(tmp_path / "c.jsonl")).orderBy("pos").collect() for m in r.messages if m.role == "user"]
    assert got == [str(r["instruction"] if "instruction" in r else r["messages"][0]["content"]) for r in map(json.loads, chats)]
