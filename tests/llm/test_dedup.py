"""Exact, near, line and byte-string dedup against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from textmill.llm import components, exact_dedup, line_dedup, near_dedup, repeats


@pytest.fixture(scope="module")
def odd(spark):
    return plain.table(spark, plain.odd_rows())


def counted(df, *names) -> Counter:
    return Counter(tuple(r[n] for n in names) for r in df.collect())


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_copies(odd):
    assert counted(exact_dedup.exact_copies(odd), *EXACT) == plain.exact(plain.odd_rows())


def test_exact_copies_under_a_weak_digest(odd):
    weak = exact_dedup.exact_copies(odd, lambda t: F.length(t) % 2)
    assert counted(weak, *EXACT) == plain.exact(plain.odd_rows())


def test_exact_copies_dropped(odd):
    rows = exact_dedup.drop_exact_copies(odd)
    assert rows.columns == odd.columns
    want = Counter(k[0] for k, n in plain.exact(plain.odd_rows()).items() if k[3] for _ in range(n))
    assert counted(rows.select("doc_id"), "doc_id") == Counter({(k,): n for k, n in want.items()})


def test_state_continues_with_more_files(spark, tmp_path):
    at, state, out = (str(tmp_path / n) for n in ("in", "checkpoint", "out"))
    schema = "id long, digest string, sha string, locator string"
    for ids in ([5, 7], [3, 9]):
        rows = [(i, "x" if i != 9 else "y", "", f"file{i}") for i in ids]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(at)
        exact_dedup.update_state(spark, at, spark.read.parquet(at).schema, state, out)
    got = {r.digest: (r.keep_id, r.locator, r.n) for r in exact_dedup.read_state(spark, out).collect()}
    assert got == {"x": (3, "file3", 3), "y": (9, "file9", 1)}


def near_found(df) -> dict:
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None}


def test_near_copies(odd):
    found = near_dedup.near_copies(odd)
    assert found.count() == len(plain.odd_rows())
    assert near_found(found) == plain.near(plain.odd_rows())
    kept = near_dedup.drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} - {None} == {i for i, (_, c) in plain.near(plain.odd_rows()).items() if i == c}


def test_near_copies_of_a_large_group(spark):
    """More copies than a node compares at once, all different, and a chain of small steps."""
    words = plain.prose(11, 200).split(" ")
    rows = []
    for i in range(160):
        own = list(words)
        for k in random.Random(i).sample(range(200), 1 + i % 2):
            own[k] = f"w{i}"
        rows.append((i, " ".join(own), None, None, None))
    for i in range(160, 175):
        own = plain.prose(12, 200).split(" ")
        own[:10 * (i - 159)] = [f"c{k}" for k in range(10 * (i - 159))]
        rows.append((i, " ".join(own), None, None, None))
    assert near_found(near_dedup.near_copies(plain.table(spark, rows, False))) == plain.near(rows)


def changed(words: list[str], seed: int, n: int) -> list[str]:
    """``words`` with ``n`` words, far from each other, put in their place that no other seed has."""
    own = list(words)
    for k in random.Random(seed).sample(range(6, len(words) - 6, 6), n):
        own[k] = f"w{seed}"
    return own


def as_rows(texts: list[list[str]]) -> list[tuple]:
    return [(i, " ".join(t), None, None, None) for i, t in enumerate(texts)]


def test_near_copies_of_a_star(spark):
    """Copies like one text, but not each other; that text has neither the first nor the last id."""
    centre = plain.prose(13, 404).split(" ")
    texts = [changed(centre, i, 6) for i in range(300)]
    rows = as_rows([*texts[:150], centre, *texts[150:]])
    want = plain.near(rows)
    assert {c for _, c in want.values()} == {0}
    assert near_found(near_dedup.near_copies(plain.table(spark, rows, False))) == want


def test_near_copies_of_a_template(spark):
    """Couples just above the threshold, all else of the group just below it."""
    template = plain.prose(14, 404).split(" ")
    rows = as_rows([changed(changed(template, 1000 + i // 2, 2), i, 3) for i in range(60)])
    want = plain.near(rows)
    assert len({c for _, c in want.values()}) > 20
    assert near_found(near_dedup.near_copies(plain.table(spark, rows, False))) == want


whole = near_dedup.confirmed


def test_near_copies_below_the_threshold(spark, monkeypatch):
    """A large group that is alike but not linked gives no pairs beyond a few a document, and a lower threshold links it."""
    template = plain.prose(15, 404).split(" ")
    rows = as_rows([changed(template, i, 4) for i in range(200)])
    asked = []
    monkeypatch.setattr(near_dedup, "confirmed", lambda docs, pairs, percent: asked.append(pairs.count()) or whole(docs, pairs, percent))
    monkeypatch.setattr(near_dedup, "TILE_ROWS", 64)
    docs = plain.table(spark, rows, False)
    assert near_found(near_dedup.near_copies(docs)) == plain.near(rows)
    assert len(asked) == 1 and asked[0] <= near_dedup.TREES * 4 * len(rows)
    want = plain.near(rows, 80)
    assert {c for _, c in want.values()} == {0}
    assert near_found(near_dedup.near_copies(docs, 80)) == want


def test_links_inside_a_node(spark, monkeypatch):
    """What full sets link is joined by fewer rows than documents a block, also across parts."""
    template = plain.prose(16, 404).split(" ")
    texts = [changed(changed(template, 1000 + i // 3, 3), i, 1) for i in range(90)]
    docs = plain.table(spark, as_rows(texts), False)
    sizes = near_dedup.signatures(docs).selectExpr("7L AS node", "id", "n", "id AS component")
    want = {i: c for i, (_, c) in plain.near(as_rows(texts)).items()}
    for tile in (1024, 20):
        monkeypatch.setattr(near_dedup, "TILE_ROWS", tile)
        links = near_dedup.confirmed_in_place(docs, sizes)
        if tile > 90:
            assert links.count() == 90 - len(set(want.values()))
        found = {r.id: r.component for r in components.components(links).collect()}
        assert {i: found.get(i, i) for i in want} == want


def test_shared_elements():
    turn = np.random.default_rng(3)
    sets = [np.unique(turn.choice(np.arange(4_000, dtype=np.uint64), turn.integers(1, 900))) for _ in range(70)]
    sets += [np.arange(1_500, dtype=np.uint64)] * 40 + [np.array([9_999], np.uint64)]
    got = near_dedup.shared(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(np.intersect1d(a, b))
    assert near_dedup.shared([np.zeros(0, np.uint64)] * 2).sum() == 0
    links = turn.random((60, 60)) < 0.03
    links |= links.T
    parts = near_dedup.forest(links)
    reach = links | np.eye(60, dtype=bool)
    for _ in range(6):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    assert len(parts) == 60 - len({tuple(r) for r in reach.tolist()}) and all(links[i, j] for i, j in parts)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_near_copies_of_the_table(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    assert near_found(near_dedup.near_copies(docs)) == plain.near([tuple(r) for r in docs.collect()])


def test_components(spark):
    turn = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(turn.randint(200, 260), turn.randint(200, 260)) for _ in range(40)]
    parent = {x: x for p in links for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for p in links if p[0] != p[1] for x in p}


BYTES = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def repeats_of(spark, texts, clashes=False, **options):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    found = repeats.without_repeats(plain.table(spark, rows, clashes), **options)
    return [tuple(r[n] for n in BYTES) for r in found.orderBy("doc_id").collect()]


def test_repeated_strings_of_odd_rows(spark):
    texts = [r[1] for r in plain.odd_rows()]
    assert repeats_of(spark, texts, True) == plain.repeated_bytes([(t or "").encode() for t in texts])


@pytest.mark.parametrize("seed", range(3))
def test_repeated_strings(spark, seed, monkeypatch):
    """Passages that begin and end anywhere, low-entropy text, limits of the length; small groups force
    the way for large ones."""
    turn = random.Random(seed)
    passage = plain.prose(50 + seed, 300)
    texts = ["a" * 450, "ab" * 300, passage[:199], passage[:200], passage[100:300] + "x", "é" * 130]
    for i in range(40):
        a = turn.randint(0, 1200)
        texts.append(plain.prose(100 + i, turn.randint(0, 60)) + passage[a : a + turn.randint(150, 500)] + plain.prose(200 + i, 20))
    texts.append(passage + " " + passage)
    if seed:
        monkeypatch.setattr(repeats, "SORT_GROUP", 3)
        monkeypatch.setattr(repeats, "HOT_ROWS", 2)
    if seed == 2:
        monkeypatch.setattr(repeats, "BLOCK_BITS", 2)
        monkeypatch.setattr(repeats, "PART_NAMES", 100)
    assert repeats_of(spark, texts) == plain.repeated_bytes([t.encode() for t in texts])


def test_repeated_strings_of_near_copies(spark, monkeypatch):
    """Many copies with a change of their own each: names of a context's strings stay in rows by block."""
    turn, words = random.Random(8), plain.prose(77, 120).split(" ")
    texts = []
    for i in range(120):
        own = list(words)
        own[turn.randrange(120)] = f"w{i % 90}"
        texts.append(" ".join(own))
    monkeypatch.setattr(repeats, "SORT_GROUP", 16)
    rows = []
    named = repeats._named

    def counted(length, parts):
        run = named(length, parts)
        rows.append((length, parts))
        return run

    monkeypatch.setattr(repeats, "_named", counted)
    assert repeats_of(spark, texts) == plain.repeated_bytes([t.encode() for t in texts])
    assert rows == [(200, 1)]  # all names meet in one part


def test_repeated_strings_of_repeated_rows(spark):
    rows = [(1, "x" * 10 + plain.prose(9, 60), None, None, None)] * 2 + [(2, plain.prose(10, 80), None, None, None)]
    got = sorted(tuple(r)[:3] for r in repeats.without_repeats(plain.table(spark, rows, False)).collect())
    whole = len(rows[0][1])
    assert got == [(1, whole, whole), (1, whole, whole), (2, len(rows[2][1]), 0)]


def test_alignment():
    assert line_dedup.aligned(list("abcdef"), list("xbcdyf")) == [(1, 1), (2, 2), (3, 3), (5, 5)]
    turn = random.Random(5)
    for _ in range(500):
        a, b = ([turn.choice("abcdefgh") for _ in range(turn.randint(0, 14))] for _ in range(2))
        pairs = line_dedup.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(line_dedup.aligned(a, a)) == len(a)


def test_line_dedup(spark):
    one, two, three, own = (plain.prose(i, 14) for i in range(21, 25))
    rows = [
        (1, "\n".join([one, two, three]), None, None, None),
        (2, "\n".join([own, one, two, "end"]), None, None, None),  # a block in another place
        (3, "\n".join([three, one]), None, None, None),  # two blocks, crossing: one of them is aligned
        (4, None, None, None, None), (5, "", None, None, None), (6, "\n\n", None, None, None),
        (7, "\n".join([one, two, three]), None, None, None), (7, "\n".join([one, two, three]), None, None, None),
        (8, "short\nlines", None, None, None), (9, "short\nlines", None, None, None),
    ]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in line_dedup.without_common_blocks(plain.table(spark, rows), least=50).collect()}
    assert got[1] == (3, 0, rows[0][1])
    assert got[2] == (4, 2, f"{own}\nend")
    assert got[3][:2] == (2, 1)
    assert got[4] == got[5] == (0, 0, "") and got[6] == (3, 0, "\n\n")
    assert got[7] == (3, 3, "")
    assert got[9] == (2, 0, "short\nlines")


def test_line_dedup_of_a_group_of_any_size(spark):
    """Every line is in more documents than are rare; the group's members are found all the same."""
    lines = [plain.prose(i, 14) for i in range(5)]
    rows = [(i, "\n".join([f"{i} first", *lines]), None, None, None) for i in range(30)]
    got = line_dedup.without_common_blocks(plain.table(spark, rows, False), rare=3).where("doc_id > 0")
    assert {(r.n_removed, r.kept == f"{r.doc_id} first") for r in got.collect()} == {(5, True)}


def test_line_dedup_of_lines_with_other_first_holders(spark):
    one, two = "a" * 60, "b" * 60
    short = "\n".join(f"{i} of it" for i in range(20))
    texts = [f"{one}\nx", f"y\n{two}", f"{one}\n{two}\nz", f"own\n{one}\n{two}", f"{short}\nv", f"w\n{short}"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {r.doc_id: r.kept for r in line_dedup.without_common_blocks(plain.table(spark, rows, False)).collect()}
    assert got == dict(enumerate([*texts[:3], "own", texts[4], "w"]))


def test_line_dedup_of_a_frequent_block_beside_a_rare_line(spark):
    block, own = [plain.prose(i, 14) for i in range(5)], [plain.prose(100 + i // 2, 8) for i in range(121)]
    rows = [(i, "\n".join([f"{i} first", own[i], "between", *block]), None, None, None) for i in range(121)]
    got = line_dedup.without_common_blocks(plain.table(spark, rows, False)).where("doc_id > 0").collect()
    assert {r.doc_id for r in got if block[0] not in r.kept and block[4] not in r.kept} == set(range(1, 121))


@pytest.mark.parametrize("run", [
    exact_dedup.exact_copies, exact_dedup.drop_exact_copies, near_dedup.near_copies, near_dedup.drop_near_copies,
    repeats.without_repeats, line_dedup.without_common_blocks])
def test_empty_table(spark, run):
    assert run(plain.table(spark, [])).collect() == []


def test_near_copies_go_to_python_in_small_batches(spark, monkeypatch):
    """A batch of texts or whole sets has a bounded number of rows, and the session's setting is as before."""
    from textmill.llm import near_dedup
    from textmill.workspace import SMALL_BATCH

    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)
    staged = near_dedup.stage
    monkeypatch.setattr(near_dedup, "stage", lambda df, name: seen.append((name, int(spark.conf.get(key)))) or staged(df, name))
    docs = spark.createDataFrame([(i, f"a b c d e f g h i j k l m n o p q r s t {i // 2}") for i in range(8)], "doc_id long, text string")
    assert near_dedup.near_copies(docs).where("kept").count() >= 1
    assert {"signatures", "sets", "links"} <= {name for name, _ in seen} and all(0 < rows <= SMALL_BATCH for _, rows in seen)
    assert spark.conf.get(key) == before
