"""Corpus sources: text lines, JSON lines, JSON files and Parquet as one ordered table of texts.

Every row carries the order key of its record:

``src_ord``     position of the input in the caller's list
``file_class``  which group of files it was listed in (the order of ``CLASSES``)
``file_parts``  the path, split at "/"
``blk``         start of the file block the row was read from
``pos``         order inside the block

Sorting by these columns gives the order in which a sequential reader would meet the records.
``pos`` comes from the running scan, so write the rows (``workspace.stage``) before an
operator that has to read the same row twice.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.text import (
    RECORD_FIELDS, choose_text, python_str, record_text, strip, variant_field, variant_string,
)

# File groups in reading order. A file can be in two of them and is read twice then.
CLASSES = ("*.jsonl", "*.json", "*.txt", "*.parquet", "wiki_*")
# Keys of a JSON file whose list holds the records, best first.
ENVELOPE_KEYS = ("data", "train", "rows", "documents")

ORDER = ["src_ord", "file_class", "file_parts", "blk", "pos"]
_END = "#end of record#"


def _hadoop_path(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle, handle.getFileSystem(spark._jsc.hadoopConfiguration())


def literal(path: str) -> str:
    """The path for a reader that would take ``[``, ``{``, ``*`` or ``?`` in it as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _unescaped(path: str) -> str:
    return re.sub(r"\\(.)", r"\1", path)


def path_exists(spark: SparkSession, path: str) -> bool:
    handle, fs = _hadoop_path(spark, path)
    return fs.exists(handle)


def is_file(spark: SparkSession, path: str) -> bool:
    handle, fs = _hadoop_path(spark, path)
    return fs.exists(handle) and fs.getFileStatus(handle).isFile()


def _parts(uri: Column) -> Column:
    """Path components; the metadata column is URI-encoded, and "+" stands for itself there."""
    return F.split(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), "/")


def _keyed(df: DataFrame, file_class: int, *columns: Column) -> DataFrame:
    return df.select(
        F.lit(file_class).alias("file_class"),
        _parts(F.col("_metadata.file_path")).alias("file_parts"),
        F.col("_metadata.file_block_start").alias("blk"),
        *columns,
    )


def _reader(spark: SparkSession, glob: str | None):
    reader = spark.read
    if glob is not None:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader


def _kind(name: str) -> str | None:
    """How a file is read."""
    for kind in ("txt", "json", "parquet"):
        if name.endswith("." + kind):
            return kind
    return "jsonl" if name.endswith(".jsonl") or name.startswith("wiki_") else None


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under ``path`` as the sources would read them: ``file_class, file_parts, kind``."""
    if is_file(spark, path):
        listed = spark.read.format("binaryFile").load(literal(path))
        classes = F.array(F.lit(0))
    else:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(literal(path))
        name = F.element_at(_parts(F.col("_metadata.file_path")), -1)
        classes = F.array_compact(F.array(*[
            F.when(name.startswith("wiki_") if glob == "wiki_*" else name.endswith(glob[1:]), F.lit(i))
            for i, glob in enumerate(CLASSES)
        ]))
    name = F.element_at("file_parts", -1)
    kind = (
        F.when(name.endswith(".txt"), "txt").when(name.endswith(".json"), "json")
        .when(name.endswith(".parquet"), "parquet")
        .when(name.endswith(".jsonl") | name.startswith("wiki_"), "jsonl")
    )
    return (
        listed.select(F.explode(classes).alias("file_class"),
                      _parts(F.col("_metadata.file_path")).alias("file_parts"))
        .withColumn("kind", kind)
    )


def text_lines(spark: SparkSession, path: str, glob: str | None = None, file_class: int = 0) -> DataFrame:
    """One record per line, line ends cut (they are stripped later in any case)."""
    lines = _reader(spark, glob).text(path)
    return _keyed(lines, file_class, F.monotonically_increasing_id().alias("pos"), F.col("value").alias("raw"))


_FIELDS = [T.StructField("bare", T.StringType())] + [
    T.StructField(f"f{i}", T.StringType()) for i in range(len(RECORD_FIELDS))]
_REPARSED = T.StructType([
    T.StructField("valid", T.BooleanType()), T.StructField("object", T.BooleanType()),
    T.StructField("as_text", T.StringType()), *_FIELDS])
_REPARSED_FILE = T.StructType([
    T.StructField("valid", T.BooleanType()), T.StructField("items", T.ArrayType(T.StructType(_FIELDS)))])


def second_parser(found: T.StructType, describe):
    """A Python function for texts the JVM parser refused: malformed, over its size limits, NaN, repeated keys.

    ``describe(value)`` gives the fields of ``found`` besides ``valid``, or None for a value that will not do.
    """
    @F.arrow_udf(found)
    def reparse(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def one(text):
            if text is None:
                return None
            try:
                described = describe(json.loads(text))
            except ValueError:
                described = None
            return {"valid": False} if described is None else {"valid": True} | described

        kind = to_arrow_type(found)
        for batch in texts:
            yield pa.array([one(text) for text in batch.to_pylist()], kind)

    return reparse


def _described(record) -> dict:
    """The string fields of a record."""
    def only_string(value):
        return value if isinstance(value, str) else None

    fields = record if isinstance(record, dict) else {}
    return {"bare": only_string(record)} | {f"f{i}": only_string(fields.get(n)) for i, n in enumerate(RECORD_FIELDS)}


def _described_line(record) -> dict:
    is_object = isinstance(record, dict)
    text = str(record["text"]) if is_object and "text" in record else ""
    return {"object": is_object, "as_text": text} | _described(record)


def _described_file(value) -> dict:
    items = [value]
    if isinstance(value, dict):
        items = next((value[k] for k in ENVELOPE_KEYS if isinstance(value.get(k), list)), items)
    elif isinstance(value, list):
        items = value
    else:
        items = []  # a scalar holds no record
    return {"items": [_described(item) for item in items]}


_reparse = second_parser(_REPARSED, _described_line)
_reparse_file = second_parser(_REPARSED_FILE, _described_file)


def _keys(df: DataFrame) -> list[str]:
    return [c for c in ORDER if c in df.columns and c != "pos"]


def line_scan(spark: SparkSession, path, glob: str | None = None, file_class: int = 0) -> DataFrame:
    """Stripped non-blank lines, not numbered yet."""
    lines = _keyed(_reader(spark, glob).text(path), file_class, strip(F.col("value")).alias("raw"))
    return lines.where(F.col("raw") != "")


def prints_in_python(value: Column, text: Column) -> Column:
    """Whether ``str()`` of a JSON value is left to the second parser: nested values, and a zero whose sign a variant does not keep."""
    kind = F.schema_of_variant(value)
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    zero = text.contains("-0") & F.coalesce(F.try_variant_get(value, "$", "double") == 0, F.lit(False))
    return F.coalesce(nested | zero, F.lit(False))


def parsed_values(rows: DataFrame, text: str = "raw", again=_reparse, refuse=None) -> DataFrame:
    """Rows with ``record`` (the text as a variant) or, where the JVM refused, ``again``.

    The text is parsed inside an array that ends in a marker, so that anything after the value
    makes it malformed; a bare ``try_parse_json`` stops after the first value. Records for which
    ``refuse(record, text)`` holds go to the second parser too.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit(f',"{_END}"]')))
    whole = (F.try_variant_get("wrapped", "$[1]", "string") == _END) & F.try_variant_get(
        "wrapped", "$[2]", "variant"
    ).isNull()
    first = F.try_variant_get("wrapped", "$[0]", "variant")
    record = F.when(whole & ~refuse(first, F.col(text)) if refuse else whole, first)
    # The row number is made here because no filter is pushed below it: a filter on the record
    # would otherwise parse every text once more.
    return rows.withColumn("wrapped", wrapped).withColumn("record", record).select(
        *_keys(rows), F.monotonically_increasing_id().alias("pos"), text, "record",
        again(F.when(F.col("record").isNull(), F.col(text))).alias("again"),
    )


def is_object(record: Column) -> Column:
    return F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))


def _again_text(found: Column) -> Column:
    return choose_text(lambda n: found[f"f{RECORD_FIELDS.index(n)}"], found["bare"])


def _line_texts(lines: DataFrame) -> DataFrame:
    """Tolerant reading of JSON lines."""
    raw = F.when(F.col("record").isNotNull(), record_text(F.col("record"))).otherwise(_again_text(F.col("again")))
    parsed = parsed_values(lines)
    return parsed.where(F.col("record").isNotNull() | F.col("again.valid")).select(
        *_keys(lines), "pos", raw.alias("raw")
    )


def json_lines(spark: SparkSession, path: str, glob: str | None = None, file_class: int = 0) -> DataFrame:
    """Tolerant JSON lines: blank and malformed lines are left out, any JSON value is a record."""
    return _line_texts(line_scan(spark, path, glob, file_class))


def strict_json_lines(spark: SparkSession, path, glob: str | None = None, file_class: int = 0) -> DataFrame:
    """JSON lines whose document is ``str(record["text"])``; a line that is no object fails the job."""
    lines = line_scan(spark, path, glob, file_class)
    refused = F.concat(F.lit("malformed JSON line: "), F.substr("raw", F.lit(1), F.lit(80)))
    raw = (
        F.when(is_object(F.col("record")), python_str(variant_field(F.col("record"), "text")))
        .when(F.col("again.valid") & F.col("again.object"), F.col("again.as_text"))
        .otherwise(F.raise_error(refused))
    )
    parsed = parsed_values(lines, refuse=lambda record, text: prints_in_python(variant_field(record, "text"), text))
    return parsed.select(*_keys(lines), "pos", raw.alias("raw"))


def _file_scan(spark: SparkSession, path: str, glob: str | None = None, file_class: int = 0) -> DataFrame:
    return _keyed(_reader(spark, glob).text(path, wholetext=True), file_class, strip(F.col("value")).alias("body"))


def _file_texts(files: DataFrame) -> DataFrame:
    record = F.col("record")
    lists = [F.try_variant_get(variant_field(record, k), "$", "array<variant>") for k in ENVELOPE_KEYS]
    items = (
        F.when(is_object(record), F.coalesce(*lists, F.array(record)))
        .otherwise(F.coalesce(F.try_variant_get(record, "$", "array<variant>"), F.array().cast("array<variant>")))
    )
    refused = F.concat(F.lit("malformed JSON file: "), F.array_join("file_parts", "/"))
    again = F.when(F.col("again.valid"), F.col("again.items")).otherwise(F.raise_error(refused))
    nothing = T.StructType(_FIELDS).simpleString()
    both = F.when(
        record.isNotNull(), F.transform(items, lambda v: F.struct(v.alias("v"), F.lit(None).cast(nothing).alias("again")))
    ).otherwise(F.transform(again, lambda x: F.struct(F.lit(None).cast("variant").alias("v"), x.alias("again"))))
    raw = F.when(F.col("item.v").isNotNull(), record_text(F.col("item.v"))).otherwise(_again_text(F.col("item.again")))
    return (
        parsed_values(files, "body", _reparse_file).select(*_keys(files), F.posexplode(both).alias("pos", "item"))
        .select(*_keys(files), F.col("pos").cast("long").alias("pos"), raw.alias("raw"))
    )


def json_file(spark: SparkSession, path: str, glob: str | None = None, file_class: int = 0) -> DataFrame:
    """Whole JSON files: the items of a list, of the first list under an envelope key, or the object.

    A file that the JVM parser refuses is read by the second parser, which also knows NaN and values of any size.
    """
    return _file_texts(_file_scan(spark, path, glob, file_class))


def parquet_rows(spark: SparkSession, path: str, glob: str | None = None, file_class: int = 0) -> DataFrame:
    """Parquet rows; only string columns with one of the known names are read."""
    def texts(df: DataFrame) -> DataFrame:
        strings = {f.name for f in df.schema.fields if f.dataType == T.StringType()}
        raw = choose_text(lambda n: F.col(f"`{n}`") if n in strings else F.lit(None).cast("string"))
        return _keyed(df, file_class, F.col("_metadata.row_index").alias("pos"), raw.alias("raw"))

    try:
        return texts(_reader(spark, glob).option("mergeSchema", True).parquet(path))
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
    # A name has different types in different files: the files of one schema are read together.
    by_schema: dict[str, list[str]] = {}
    for row in input_files(spark, _unescaped(path)).where("kind = 'parquet'").select("file_parts").distinct().toLocalIterator():
        file = "/".join(row.file_parts)
        if glob in (None, "*.parquet") or row.file_parts[-1].startswith("wiki_"):
            by_schema.setdefault(spark.read.parquet(literal(file)).schema.json(), []).append(literal(file))
    return reduce(DataFrame.unionByName, [texts(spark.read.parquet(*files)) for files in by_schema.values()])


# How each kind of file is scanned, and how the scanned rows become texts.
_SCANS = {"jsonl": line_scan, "json": _file_scan, "txt": text_lines, "parquet": parquet_rows}
_EXTRACTS = {"jsonl": _line_texts, "json": _file_texts}


def _scans(spark: SparkSession, path: str) -> list[tuple[str, DataFrame]]:
    """Scans of one file or directory, each with its kind.

    A folder named ``*.jsonl`` is one JSON-lines file in parts, as the sink writes it.
    """
    if path.rstrip("/").endswith(".jsonl"):
        return [("jsonl", line_scan(spark, literal(path)))]
    if is_file(spark, path):
        kind = _kind(path.rsplit("/", 1)[-1])
        return [(kind, _SCANS[kind](spark, literal(path)))] if kind else []
    present = input_files(spark, path).select("file_class", "kind").distinct().collect()
    found, path = [], literal(path)
    for file_class, kind in sorted((r.file_class, r.kind) for r in present):
        glob = CLASSES[file_class]
        if glob == "wiki_*" and kind == "jsonl":
            named = F.element_at("file_parts", -1)
            lines = line_scan(spark, path, glob, file_class)
            found.append((kind, lines.where(~named.rlike(r"\.(json|txt|parquet)$"))))
        else:
            found.append((kind, _SCANS[kind](spark, path, f"wiki_*.{kind}" if glob == "wiki_*" else glob, file_class)))
    return found


def read_corpus(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of all inputs with the full order key; inputs that do not exist are skipped.

    Scans of a kind are put together before they are parsed, so the plan has one parser however
    many inputs there are.
    """
    by_kind: dict[str, list[DataFrame]] = {}
    for number, path in enumerate(paths):
        if not path_exists(spark, path):
            print(f"skip missing: {path}", file=sys.stderr)
            continue
        for kind, scan in _scans(spark, path):
            by_kind.setdefault(kind, []).append(scan.withColumn("src_ord", F.lit(number)))
    found = []
    for kind, scans in by_kind.items():
        together = reduce(DataFrame.unionByName, scans)
        found.append(_EXTRACTS.get(kind, lambda df: df)(together).select(*ORDER, "raw"))
    if not found:
        return spark.createDataFrame(
            [], "src_ord int, file_class int, file_parts array<string>, blk long, pos long, raw string"
        )
    return reduce(DataFrame.unionByName, found)


def wiki_shards(spark: SparkSession, path: str) -> DataFrame:
    """Strict JSON lines of all ``wiki_*`` files under a folder, with the full order key."""
    rows = strict_json_lines(spark, literal(path), "wiki_*")
    return rows.select(F.lit(0).alias("src_ord"), *ORDER[1:], "raw")
