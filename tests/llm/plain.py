"""Rows with all the odd cases, and plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = re.compile(r"[\x20\x09-\x0D]+")

# Further columns whose names the operators use inside.
CLASHES = ("id", "key", "_id", "_sha", "_row", "_key", "_dropped", "n", "size", "row", "runs", "run", "kept", "h", "s", "found", "label")


def prose(seed: int, words: int) -> str:
    turn = random.Random(seed)
    return " ".join("".join(turn.choice("abcdefghij") for _ in range(turn.randint(2, 7))) for _ in range(words))


def odd_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, repeated rows, ties."""
    base, other = prose(1, 120), prose(2, 120)
    near = base.split(" ")
    near[60] = "changed"
    texts = [
        base, None, "", " \t\n", "one", base.replace(" ", "\n"), " ".join(near), other, "Ein Wort mehr als drei\x0b\x0cEnde",
        "one", prose(3, 30_000), "a" * 5_000, "\n".join([prose(4, 12), prose(5, 14), prose(6, 9)]),
        "\n".join([prose(7, 6), prose(4, 12), prose(5, 14), prose(6, 9)]), "日本語 \U0001f600 tekst", None, "ONE", " one ",
    ]
    rows = [(i, t, "en", "src" + str(i % 3) if i % 5 else None, len(t) if t else None) for i, t in enumerate(texts)]
    rows.append(rows[7])  # a repeated row
    rows.append((None, base, None, None, None))
    return rows


def table(spark, rows: list[tuple], clashes: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.withColumns({c: F.lit(c) for c in CLASHES}) if clashes else df


def exact(rows: list[tuple]) -> Counter:
    """(doc_id, keep_id, group_size, kept, sha256) of every row."""
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[SPACES.sub(" ", text or "")].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, stays = min(known) if known else None, False
        for i in ids:
            kept = i == keep and not stays
            stays |= kept
            out[(i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


def shingles(text: str | None) -> frozenset:
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = WORD.findall((text or "").translate(lower))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near(rows: list[tuple], percent: int = 85) -> dict:
    """doc_id -> (set size, component)."""
    sets = {row[0]: shingles(row[1]) for row in rows if row[0] is not None}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    together = Counter()
    for ids in holders.values():
        together.update((a, b) for k, a in enumerate(ids) for b in ids[k + 1 :])
    for (a, b), n in together.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def repeated_bytes(texts: list[bytes], length: int = 200) -> list[tuple]:
    """(bytes, removed, spans, sha256 of the rest) of every text."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        rest = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(rest).hexdigest()))
    return out
