"""Sources of the training side: plain samples, chat samples and tokenizer text."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.chat import SAMPLE_FIELDS, built_messages, record_messages
from ..functions.text import strip, variant_field
from .files import (
    is_object, line_scan, literal, parsed_values, path_exists, prints_in_python, second_parser, strict_json_lines, text_lines,
)


def _texts(lines: DataFrame) -> DataFrame:
    text = strip(F.col("raw"))
    return lines.select("file_class", "file_parts", "blk", "pos", text.alias("text")).where("text != ''")


def pretrain_samples(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty stripped texts; JSON lines when the name ends in ``.jsonl``, else plain lines.

    ``path`` may be a folder of part files, as the sinks write them.
    """
    read = strict_json_lines if path.rstrip("/").endswith(".jsonl") else text_lines
    return _texts(read(spark, literal(path)))


_MESSAGES = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))
_SAMPLE = T.StructType([
    T.StructField("valid", T.BooleanType()), T.StructField("messages", _MESSAGES),
    *(T.StructField(n, T.StringType()) for n in SAMPLE_FIELDS)])


def _described_sample(record) -> dict | None:
    """What a chat sample holds, as strings; None when it is no such sample."""
    if not isinstance(record, dict):
        return None
    if "messages" not in record:
        return {n: str(record[n]) for n in SAMPLE_FIELDS if n in record}
    messages = record["messages"] or []
    if not isinstance(messages, list) or not all(isinstance(m, dict) and m.keys() >= {"role", "content"} for m in messages):
        return None
    return {"messages": [{k: str(m[k]) for k in ("role", "content")} for m in messages]}


_resample = second_parser(_SAMPLE, _described_sample)


def _printed_in_python(record: Column, text: Column) -> Column:
    """Whether a sample has a field or message whose ``str()`` the second parser makes."""
    def any_of(holder: Column, names: tuple[str, ...]) -> Column:
        return reduce(operator.or_, [prints_in_python(variant_field(holder, n), text) for n in names])

    messages = F.try_variant_get(variant_field(record, "messages"), "$", "array<variant>")
    listed = F.coalesce(F.exists(messages, lambda m: any_of(m, ("role", "content"))), F.lit(False))
    return F.when(variant_field(record, "messages").isNull(), any_of(record, SAMPLE_FIELDS)).otherwise(listed)


def chat_samples(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines turned into ``messages``; samples without any message are left out.

    A line that is no object, or whose messages are no list of objects with role and content, fails the job.
    """
    parsed = parsed_values(line_scan(spark, literal(path)), again=_resample, refuse=_printed_in_python)
    again = F.col("again")
    messages = F.when(is_object(F.col("record")), record_messages(F.col("record"))).when(
        again["valid"], F.coalesce(again["messages"], built_messages(lambda n: again[n])))
    refused = F.raise_error(F.concat(F.lit("not a chat sample: "), F.substr("raw", F.lit(1), F.lit(80))))
    return parsed.select(
        "file_class", "file_parts", "blk", "pos", F.coalesce(messages, refused).alias("messages")
    ).where(F.size("messages") > 0)


def tokenizer_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Non-empty texts of the ``.txt`` and ``.jsonl`` files directly in a folder."""
    def listed(pattern: str) -> str | None:
        full = f"{literal(folder.rstrip('/'))}/{pattern}"
        path = spark._jvm.org.apache.hadoop.fs.Path(full)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        return full if found is not None and len(found) > 0 else None

    if not path_exists(spark, folder):
        raise FileNotFoundError(folder)
    parts = []
    if path := listed("*.txt"):
        parts.append(_texts(text_lines(spark, path)))
    if path := listed("*.jsonl"):
        parts.append(_texts(strict_json_lines(spark, path)))
    if not parts:
        raise ValueError(f"no .txt or .jsonl file in {folder}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
