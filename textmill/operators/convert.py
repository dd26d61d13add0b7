"""Dictionary conversion of text, leftmost-longest, as traditional to simplified script needs."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..workspace import stage

# A dictionary goes to every worker, so its size is measured; a larger one is refused.
MAX_BYTES = 256 << 20
# Spark looks a map key up by scanning; with more long entries than this a Python worker is faster.
MAX_JVM_PHRASES = 1_000
# A table with more entries stays a table: only entries that stand in a text go to the workers, up to as many.
SENT_ENTRIES = 50_000
# Bits of the filter that tells workers what may be an entry, and what a task remembers to have found.
FILTER_BITS = 1 << 26
SEEN = 100_000
# Parts in which the texts that hold an entry meet it.
SALTS = 16


def entries_of(table: DataFrame) -> DataFrame:
    """Entries of a ``src, dst`` table, any number of them.

    Rows without ``src`` or ``dst`` and those with an empty ``src`` are no entries. Of several rows for a ``src`` the smallest
    ``dst`` counts.
    """
    return table.where("src != '' AND dst IS NOT NULL").groupBy("src").agg(F.min("dst").alias("dst"))


def load_dictionary(table: DataFrame) -> dict[str, str]:
    """``entries_of`` a table as a dictionary."""
    entries = entries_of(table)
    size = entries.agg(F.sum(F.octet_length("src") + F.octet_length("dst"))).first()[0] or 0
    if size > MAX_BYTES:
        raise ValueError(f"the entries of a conversion dictionary hold at most {MAX_BYTES} bytes, not {size}")
    return {r.src: r.dst for r in entries.toLocalIterator()}


def convert_text(text: Column, dictionary: dict[str, str]) -> Column:
    """Replace every leftmost-longest match of a dictionary entry.

    One-to-one characters go through ``translate``. With longer entries the text is cut into
    matches and the stretches between them, where no such entry begins. Entries without text to
    find or to put there are left out.
    """
    dictionary = {s: d for s, d in dictionary.items() if s and d is not None}
    single = {s: d for s, d in dictionary.items() if len(s) == 1 and len(d) == 1 and s != d and "\0" not in d}
    phrases = {s: d for s, d in dictionary.items() if s not in single and not (len(s) == 1 and s == d)}

    def chars(piece: Column) -> Column:
        return F.translate(piece, "".join(single), "".join(single.values())) if single else piece

    if not phrases:
        return chars(text)
    if len(phrases) > MAX_JVM_PHRASES:
        return _in_python(dictionary)(text)
    by_first: dict[str, list[str]] = {}
    for source in sorted(phrases, key=len, reverse=True):
        by_first.setdefault(source[0], []).append(_escaped(source[1:]))
    starts = "".join(_escaped(first) for first in by_first)
    # Entries are tried only where their first character stands, the longest first.
    entries = "|".join(f"{_escaped(first)}(?:{'|'.join(rests)})" for first, rests in by_first.items())
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)(?=[{starts}])(?:{entries})|.[^{starts}]*+"), F.lit(0))
    # One literal, folded once, instead of a map expression per entry.
    table = F.from_json(F.lit(json.dumps(phrases, ensure_ascii=False)), "map<string,string>")
    return F.array_join(F.transform(pieces, lambda p: F.coalesce(F.element_at(table, p), chars(p))), "")


def _escaped(chars: str) -> str:
    return "".join(f"\\x{{{ord(c):X}}}" for c in chars)


def _in_python(dictionary: dict[str, str]):
    """One pass over a text; at a place, one look-up for each length that entries with its character have."""
    lengths: dict[str, set[int]] = {}
    for source in dictionary:
        lengths.setdefault(source[0], set()).add(len(source))
    longest_first = {first: sorted(sizes, reverse=True) for first, sizes in lengths.items()}
    shared = SparkSession.active().sparkContext.broadcast((dictionary, longest_first))

    @F.arrow_udf("string")
    def replace(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, sizes = shared.value
        starts = _any_of(sizes)
        for batch in batches:
            yield pa.array([_replaced(t, table, sizes, starts) for t in batch.to_pylist()], pa.string())

    return replace


def _any_of(chars) -> re.Pattern:
    return re.compile("[" + re.escape("".join(chars)) + "]")


def _replaced(text: str | None, table: dict[str, str], sizes: dict[str, list[int]], starts: re.Pattern) -> str | None:
    if text is None:
        return None
    out, done = [], 0
    hit = starts.search(text)
    while hit is not None:
        at = hit.start()
        size = next((n for n in sizes[text[at]] if text[at : at + n] in table), 0)
        if size:
            out += (text[done:at], table[text[at : at + size]])
            done = at + size
        hit = starts.search(text, at + max(size, 1))
    return "".join(out) + text[done:]


def _filter(entries: DataFrame) -> bytes:
    """A bit for each hash of a ``src``; its size does not depend on the entries."""
    bit = F.crc32(F.encode("src", "UTF-8")) % FILTER_BITS
    one = F.pow(F.lit(2), bit % 8).cast("int")
    found = entries.groupBy(F.shiftright(bit, 3).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    held = np.zeros(FILTER_BITS >> 3, np.uint8)
    held[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return held.tobytes()


def _standing(rows: DataFrame, column: str, entries: DataFrame, by_row: str | None = None) -> DataFrame:
    """``src`` strings in the texts that the filter of the entries lets pass, all entries there among them.

    They may repeat. With ``by_row`` each comes with that column of its row, once for a row.
    """
    shapes = entries.select(F.substr("src", F.lit(1), F.lit(1)).alias("first"), F.char_length("src").alias("size")).distinct().collect()
    sizes: dict[str, list[int]] = {}
    for first, size in shapes:
        sizes.setdefault(first, []).append(size)
    shared = rows.sparkSession.sparkContext.broadcast((sizes, _filter(entries)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, held = shared.value
        starts, seen = _any_of(sizes), set()
        for batch in batches:
            keys, out = batch.column(0).to_pylist() if by_row else None, ([], [])
            for i, text in enumerate(batch.column(-1)):
                text, here = text.as_py(), set()
                for hit in starts.finditer(text or ""):
                    at = hit.start()
                    here.update(text[at : at + n] for n in sizes[text[at]] if at + n <= len(text))
                for src in here if by_row else here - seen:
                    bit = zlib.crc32(src.encode()) % FILTER_BITS
                    if held[bit >> 3] >> (bit & 7) & 1:
                        out[1].append(src)
                        if by_row:
                            out[0].append(keys[i])
                if not by_row:
                    seen |= here
                    if len(seen) > SEEN:
                        seen = set()
                if len(out[1]) >= SEEN:
                    yield _found(out, by_row)
                    out = ([], [])
            yield _found(out, by_row)

    schema = f"{by_row} long, src string" if by_row else "src string"
    return rows.select(*[c for c in (by_row, column) if c]).mapInArrow(run, schema)


def _found(out: tuple[list, list], by_row: str | None) -> pa.RecordBatch:
    src = pa.array(out[1], pa.string())
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), src], [by_row, "src"]) if by_row else pa.RecordBatch.from_arrays([src], ["src"])


def _convert_by_table(df: DataFrame, column: str, entries: DataFrame) -> DataFrame:
    """``convert`` with any number of written entries: only those that stand in a text meet the texts."""
    row = "_row"
    while row in df.columns:
        row += "_"
    rows = stage(df.withColumn(row, F.monotonically_increasing_id()), "texts")
    used = stage(entries.join(_standing(rows, column, entries).distinct(), "src"), "used_entries")
    if used.count() <= SENT_ENTRIES:
        return rows.drop(row).withColumn(column, convert_text(F.col(column), load_dictionary(used)))
    # A frequent entry meets its rows in several parts.
    salted = used.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = _standing(rows, column, used, row).withColumn("_salt", F.pmod(F.xxhash64(row), F.lit(SALTS)).cast("int"))
    tables = found.join(salted, ["src", "_salt"]).groupBy(row).agg(F.map_from_entries(F.collect_list(F.struct("src", "dst"))).alias("_table"))
    return rows.join(tables, row, "left").withColumn(column, _by_row(F.col(column), F.map_entries("_table"))).select(*df.columns)


@F.arrow_udf(StringType())
def _by_row(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Texts converted with a table each."""
    def one(text, entries):
        if not entries:
            return text
        table, sizes = {e["key"]: e["value"] for e in entries}, {}
        for src in sorted(table, key=len, reverse=True):
            at = sizes.setdefault(src[0], [])
            if len(src) not in at:
                at.append(len(src))
        return _replaced(text, table, sizes, _any_of(sizes))

    for texts, tables in batches:
        yield pa.array([one(t.as_py(), e.as_py()) for t, e in zip(texts, tables)], pa.string())


def convert(df: DataFrame, column: str, dictionary: dict[str, str] | DataFrame | None) -> DataFrame:
    """Convert a column in place; no dictionary leaves it as it is."""
    if dictionary is None:
        return df
    if isinstance(dictionary, DataFrame):
        entries = stage(entries_of(dictionary), "entries")
        if entries.count() > SENT_ENTRIES:
            return _convert_by_table(df, column, entries)
        dictionary = load_dictionary(entries)
    return df.withColumn(column, convert_text(F.col(column), dictionary))
