"""Whole builds against a plain statement of the rules."""

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textmill.operators import order
from textmill.plans import corpus, training
from tests.test_tokens import check_chat, check_document


def put(path, texts):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps({"text": t}, ensure_ascii=False) + "\n" for t in texts))


def read(path):
    parts = sorted(p for p in path.iterdir() if p.name.startswith("part-"))
    return [json.loads(line)["text"] for p in parts for line in p.read_text().split("\n") if line]


@pytest.fixture(scope="module")
def texts(docs):
    return [r.text for r in docs.orderBy("doc_id").collect()]


A = ["alpha one", "abc", "beta  two \r\n", "alpha one"]
B = ["gamma three", "\n beta  two"]
LINE = {"alpha one": 22, "beta  two": 22, "gamma three": 24}  # bytes of the output lines
# budget, dedupe: texts written, short ones and repeats met before the build ends
BUILDS = {
    (0, True): (["alpha one", "beta  two", "gamma three"], 1, 2),
    (0, False): (["alpha one", "beta  two", "alpha one", "gamma three", "beta  two"], 1, 0),
    (68, True): (["alpha one", "beta  two", "gamma three"], 1, 2),
    (67, True): (["alpha one", "beta  two"], 1, 1),
    (45, True): (["alpha one", "beta  two"], 1, 1),
    (44, True): (["alpha one", "beta  two"], 1, 1),
    (43, True): (["alpha one"], 1, 0),
    (44, False): (["alpha one", "beta  two"], 1, 0),
    (66, False): (["alpha one", "beta  two", "alpha one"], 1, 0),
    (22, True): (["alpha one"], 1, 0),
    (21, True): ([], 0, 0),
}


@pytest.mark.parametrize("budget,dedupe", list(BUILDS))
def test_build(spark, tmp_path, monkeypatch, budget, dedupe):
    monkeypatch.setattr(order, "BUCKET_KEYS", 2)
    put(tmp_path / "in/a.jsonl", A)
    put(tmp_path / "in/b.jsonl", B)
    report = corpus.build_corpus(spark, [str(tmp_path / "none"), str(tmp_path / "in")], str(tmp_path / "out"),
                                 5, str(budget or ""), dedupe=dedupe).first()
    wanted, short, repeated = BUILDS[budget, dedupe]
    assert read(tmp_path / "out") == wanted
    assert (report.saved, report.skipped, report.duplicated) == (len(wanted), short, repeated)
    assert report.written_bytes == sum(LINE[t] for t in wanted)


def built(spark, tmp_path, name, *parts, **options):
    paths = [tmp_path / f"{name}-in{i}.jsonl" for i in range(len(parts))]
    for path, part in zip(paths, parts):
        put(path, part)
    report = corpus.build_corpus(spark, list(map(str, paths)), str(tmp_path / name), 80, **options).first()
    return read(tmp_path / name), report


def test_build_of_documents(spark, texts, tmp_path, monkeypatch):
    monkeypatch.setattr(order, "BUCKET_KEYS", 16)
    parts = texts[:50] + ["short"], texts[40:]
    every, all_of_it = built(spark, tmp_path, "every", *parts)
    once, report = built(spark, tmp_path, "once", *parts, dedupe=True)
    assert once == list(dict.fromkeys(every)) and report.duplicated == len(every) - len(once)
    assert all_of_it.saved + all_of_it.skipped == len(texts) + 11 and all_of_it.skipped >= 1
    some, report = built(spark, tmp_path, "some", *parts, dedupe=True, max_bytes="60000")
    assert some == once[: len(some)] and len(some) < len(once)
    size = [len(json.dumps({"text": t}, ensure_ascii=False).encode()) + 1 for t in once[: len(some) + 1]]
    assert sum(size[:-1]) == report.written_bytes <= 60_000 < sum(size)


def test_mixed_build(spark, texts, tmp_path):
    parts = texts[:150], texts[100:]
    long = [built(spark, tmp_path, f"part{i}", part)[0] for i, part in enumerate(parts)]
    got, report = built(spark, tmp_path, "mixed", *parts, mix=True, seed=7)
    assert sorted(got) == sorted(long[0] + long[1]) and report.saved == len(got)
    once = [[t for t in part if long[0].count(t) + long[1].count(t) == 1] for part in long]
    for part in once:  # each input keeps its order, and they are interleaved
        assert [t for t in got if t in set(part)] == part
    assert [t for t in got if t in set(once[0] + once[1])] != once[0] + once[1]
    assert built(spark, tmp_path, "again", *parts, mix=True, seed=7)[0] == got
    # the output of one build is an input of the next
    assert corpus.build_corpus(spark, [str(tmp_path / "mixed")], str(tmp_path / "out2.jsonl"), 0).first().saved == len(got)


def test_empty_inputs(spark, tmp_path):
    report = corpus.build_corpus(spark, [str(tmp_path / "none")], str(tmp_path / "out"), 80, "1KB", dedupe=True, mix=True).first()
    assert (report.saved, report.skipped, report.duplicated, report.written_bytes) == (0, 0, 0, 0)


def test_wiki(spark, tmp_path):
    put(tmp_path / "in/A0/wiki_00", ["first page ", "tiny", "second page"])
    put(tmp_path / "in/A1/wiki_00", ["third\r\npage", "second page"])
    wanted = ["first page", "second page", "third\npage", "second page"]
    assert corpus.prepare_wiki(spark, str(tmp_path / "in"), str(tmp_path / "all.jsonl"), min_chars=10).first().saved == 4
    assert read(tmp_path / "all.jsonl") == wanted
    corpus.prepare_wiki(spark, str(tmp_path / "in"), str(tmp_path / "some.jsonl"), min_chars=10, max_docs=3, dictionary={"e": "E"})
    assert read(tmp_path / "some.jsonl") == ["first pagE", "sEcond pagE", "third\npagE"]


@pytest.mark.parametrize("ranks,epochs", [(1, 1), (3, 2)])
def test_feeds(spark, texts, tmp_path, ranks, epochs, monkeypatch):
    monkeypatch.setattr("textmill.operators.sinks.FILE_ROWS", 6)  # several files for a rank
    put(tmp_path / "t/c.jsonl", texts[:40] + ["", " "])
    vocab = training.train_tokenizer(spark, str(tmp_path / "t"), str(tmp_path / "v"), 150)
    library = Tokenizer.from_str(vocab.tokenizer_json())

    def ids(text):
        return library.encode(text, add_special_tokens=False).ids

    training.pretrain_feed(spark, str(tmp_path / "t/c.jsonl"), vocab, str(tmp_path / "f"), 32, ranks, epochs)
    rows = spark.read.parquet(str(tmp_path / "f")).collect()
    assert {r.row for r in rows} == set(range(40))
    for r in rows:
        check_document(ids(texts[r.row].strip()), r.input_ids, r.labels, 32)
    per = -(-40 // ranks)
    assert sorted((r.epoch, r.rank, r.place) for r in rows) == [
        (e, k, p) for e in range(epochs) for k in range(ranks) for p in range(per)]

    for epoch in range(epochs):
        for rank in range(ranks):  # files by name, rows as they stand
            files = sorted((tmp_path / f"f/epoch={epoch}/rank={rank}").glob("part-*"))
            places = [p for f in files for p in pq.read_table(f, columns=["place"], partitioning=None)["place"].to_pylist()]
            assert places == list(range(per))

    chats = [{"messages": [{"role": "user", "content": t[:50]}, {"role": "assistant", "content": t[50:90]}]} for t in texts[:20]]
    (tmp_path / "chat.jsonl").write_text("\n".join(json.dumps(c) for c in chats + [{"messages": []}]))
    training.sft_feed(spark, str(tmp_path / "chat.jsonl"), vocab, str(tmp_path / "g"), 64, ranks, epochs)
    rows = spark.read.parquet(str(tmp_path / "g")).collect()
    assert {r.row for r in rows} == set(range(20))
    for r in rows:
        turns = [(m["role"], ids(f"<|im_start|>{m['role']}\n{m['content']}<|im_end|>\n")) for m in chats[r.row]["messages"]]
        check_chat(turns, r.input_ids, r.labels, 64)


def folders(spark):
    from pathlib import Path

    from textmill.workspace import work_dir

    base = Path(work_dir(spark).removeprefix("file:")) / "textmill"
    return set(base.iterdir()) if base.exists() else set()


def test_staged_tables_are_deleted(spark, texts, tmp_path, monkeypatch):
    put(tmp_path / "t/c.jsonl", texts[:20])
    before = folders(spark)
    report = corpus.build_corpus(spark, [str(tmp_path / "t")], str(tmp_path / "out"), 80, "20KB", dedupe=True, mix=True)
    assert len(folders(spark) - before) == 1 and report.first().saved > 0  # the report is read later
    monkeypatch.setattr("textmill.operators.vocab.STAGE_AFTER", 4)
    before = folders(spark)
    vocab = training.train_tokenizer(spark, str(tmp_path / "t"), str(tmp_path / "v"), 120)
    training.pretrain_feed(spark, str(tmp_path / "t/c.jsonl"), vocab, str(tmp_path / "f"), 32)
    assert folders(spark) == before
    put(tmp_path / "bad/wiki_00", ["x" * 90])
    (tmp_path / "bad/wiki_01").write_text("no json")
    with pytest.raises(Exception, match="malformed JSON line"):
        corpus.prepare_wiki(spark, str(tmp_path / "bad"), str(tmp_path / "out3"))
    assert folders(spark) == before


def test_texts_are_shuffled_once_before_they_are_put_in_order(spark, texts, tmp_path, monkeypatch):
    """The join with the decisions moves the texts; blocks, budget and repeats work on narrow rows."""
    seen = {}
    monkeypatch.setattr(corpus, "write_corpus", lambda rows, path, order: seen.update(plan=rows._jdf.queryExecution().toString()))
    monkeypatch.setattr("textmill.operators.order.broadcast_if_small", lambda df: df)
    put(tmp_path / "in.jsonl", texts[:20])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        corpus.build_corpus(spark, [str(tmp_path / "in.jsonl")], str(tmp_path / "out"), 80, "20KB", dedupe=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    physical = seen["plan"].split("== Physical Plan ==")[1]
    scans = [line for line in physical.splitlines() if "FileScan" in line]
    assert sum("text#" in line for line in scans) == 1, physical


def exchanges_above(plan: str, scan: str) -> int:
    """Exchanges between the scan that reads ``scan`` and the top of the plan."""
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" +-:")) for line in lines]
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and scan in line)
    count, level = 0, depth[at]
    for i in range(at, -1, -1):
        if depth[i] < level:
            level = depth[i]
            count += "Exchange" in lines[i]
    return count


@pytest.mark.parametrize("build", ["corpus", "wiki"])
def test_texts_cross_the_network_once(spark, texts, tmp_path, monkeypatch, build):
    """Without broadcasts: the join leaves texts in place, and the order needs no sampling sort."""
    seen = {}
    monkeypatch.setattr(corpus, "write_corpus", lambda rows, path, order: seen.update(plan=rows._jdf.queryExecution().executedPlan().toString()))
    monkeypatch.setattr("textmill.operators.order.broadcast_if_small", lambda df: df)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        if build == "corpus":
            put(tmp_path / "in.jsonl", texts[:20])
            corpus.build_corpus(spark, [str(tmp_path / "in.jsonl")], str(tmp_path / "out"), 80, "20KB", dedupe=True, mix=True)
        else:
            put(tmp_path / "w/wiki_00", texts[:20])
            corpus.prepare_wiki(spark, str(tmp_path / "w"), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert exchanges_above(seen["plan"], "text#") == 1 and "rangepartitioning" not in seen["plan"], seen["plan"]
    assert "textmill" not in " ".join(t.name for t in spark.catalog.listTables()) and not [
        t for t in spark.catalog.listTables() if t.name.startswith(("prepared_", "wiki_"))]


def test_files_follow_each_other(spark, texts, tmp_path, monkeypatch):
    """Part files by name hold the corpus in order, at any size of a file."""
    put(tmp_path / "in.jsonl", texts[:60])
    whole = None
    for size in (2_000, 9_000, 1 << 30):
        monkeypatch.setattr("textmill.operators.sinks.FILE_BYTES", size)
        out = tmp_path / f"out{size}"
        corpus.build_corpus(spark, [str(tmp_path / "in.jsonl")], str(out), 80, dedupe=True, mix=True)
        lines = [line for f in sorted(out.glob("part-*")) for line in f.read_text().splitlines()]
        whole = whole or lines
        assert lines == whole and len(lines) > 20
