"""Input files made from the given tables, for queries and tests of the file sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import fresh_path, spread

# Documents in one JSON file.
FILE_DOCS = 1_000


def named_lines(df: DataFrame, folder: str, value: Column, order: str, prefix: str, suffix: str) -> None:
    """Write lines in order as ``prefix-NNNNN<suffix>`` files of ``folder``."""
    spark = df.sparkSession
    parts = fresh_path(spark, "lines")
    df.select(order, value.alias("value")).orderBy(order).select("value").write.text(parts)
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(parts), hadoop.Path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    names = sorted(f.getPath().getName() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-"))
    for number, name in enumerate(names):
        fs.rename(hadoop.Path(source, name), hadoop.Path(target, f"{prefix}-{number:05d}{suffix}"))


def mixed_record(text: Column, number: Column) -> Column:
    """JSON lines whose shape depends on ``number``; see ``MIXED_SQL`` for what they hold."""
    def obj(**fields: Column) -> Column:
        return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))

    quoted = F.substr(obj(t=text), F.lit(6))
    quoted = F.substr(quoted, F.lit(1), F.char_length(quoted) - 1)
    kind = number % 8
    return (
        F.when(kind == 0, obj(text=text))
        .when(kind == 1, obj(title=F.lit("unused"), content=text))
        .when(kind == 2, obj(**{"正文": text, "text": F.lit(" 　")}))
        .when(kind == 3, obj(answer=text, title=F.concat(F.lit(" Title "), number.cast("string"))))
        .when(kind == 4, quoted)
        .when(kind == 5, number.cast("string"))
        .when(kind == 6, F.when(number % 16 == 6, F.concat(obj(text=text), F.lit(" tail"))).otherwise(
            F.concat(F.lit('{"text": '), quoted)))
        .otherwise(obj(text=F.lit(17), data=F.lit("  "), output=text, question=F.lit("q?")))
    )


# The text of a mixed record, NULL for a malformed line; {t} is the text, {n} the number.
MIXED_SQL = """CASE {n} % 8 WHEN 3 THEN 'Title ' || {n} || chr(10) || {t} WHEN 5 THEN ''
WHEN 6 THEN NULL WHEN 7 THEN 'q?' || chr(10) || {t} ELSE {t} END"""


def json_files(df: DataFrame, folder: str, text: str, order: str, suffix: str = ".json") -> None:
    """JSON files of at most ``FILE_DOCS`` records: lists and each kind of envelope in turn."""
    rows = df.select(
        F.floor(F.col(order) / FILE_DOCS).cast("long").alias("g"), order,
        F.to_json(F.struct(F.col(text).alias("text"))).alias("record"),
    )
    listed = F.concat(F.lit("["), F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct(order, "record"))), lambda r: r["record"]), ",\n"), F.lit("]"))
    files = rows.groupBy("g").agg(listed.alias("items"))
    key = F.element_at(F.array(*[F.lit(k) for k in ("data", "train", "rows", "documents")]), (F.col("g") % 4 + 1).cast("int"))
    value = F.when(F.col("g") % 5 == 0, F.col("items")).otherwise(
        F.concat(F.lit('{"version": 2, "'), key, F.lit('": '), F.col("items"), F.lit("}")))
    spark = df.sparkSession
    parts = fresh_path(spark, "json")
    files.select(F.lpad(F.col("g").cast("string"), 12, "0").alias("g"), value.alias("value")).write.partitionBy("g").text(parts)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(folder))
    for group in fs.listStatus(hadoop.Path(parts)):
        name = group.getPath().getName()
        if name.startswith("g="):
            for file in fs.listStatus(group.getPath()):
                if file.getPath().getName().startswith("part-"):
                    fs.rename(file.getPath(), hadoop.Path(folder, f"{name[2:]}{suffix}"))


def jsonl_folder(df: DataFrame, path: str, value: Column, order: str) -> None:
    """One JSON-lines file in parts, in order."""
    df.select(order, value.alias("value")).orderBy(order).select("value").write.text(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
