"""Readers and writers of the file formats that feed and leave the engine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import url_key


def whole_texts(spark: SparkSession, folder: str) -> DataFrame:
    """path, text: a row for each file."""
    return spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def json_items(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows of files that each hold a JSON array of objects."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def url_records(spark: SparkSession, path: str, fields: tuple[str, ...] = ("id", "url", "date", "source")) -> DataFrame:
    """Files of records of as many lines as ``fields``."""
    n = len(fields)
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split(F.regexp_replace("value", r"\s+$", ""), "\r?\n")).alias("pos", "line"))
    record = lines.groupBy("path", F.floor(F.col("pos") / n).alias("record"))
    return record.agg(*(F.max(F.when(F.col("pos") % n == i, F.col("line"))).alias(f) for i, f in enumerate(fields))).drop("path", "record")


def word_vectors(spark: SparkSession, path: str, vocabulary: DataFrame) -> DataFrame:
    """word, vector of ``word v1 v2 ...`` lines for the vocabulary's words; a missing word gets small values by its hash."""
    raw = spark.read.text(path).select(F.split("value", " ").alias("p")).where("size(p) > 2")
    known = raw.select(F.element_at("p", 1).alias("word"), F.transform(F.expr("slice(p, 2, size(p) - 1)"), lambda x: x.cast("float")).alias("vector"))
    size = F.lit(known.agg(F.max(F.size("vector"))).first()[0] or 0)
    noise = F.transform(F.sequence(F.lit(1), size), lambda i: ((F.pmod(F.xxhash64("word", i), F.lit(20_011)) / 20_011.0 - 0.5) * 1.2).cast("float"))
    return vocabulary.select("word").distinct().join(known, "word", "left").select("word", F.coalesce("vector", noise).alias("vector"))


def vw_line(key: list[str], namespaces: Mapping[str, Column]) -> Column:
    """``a*b*c |text words |title words``; blanks in key parts become ``_``."""
    head = F.concat_ws("*", *(F.replace(F.col(k).cast("string"), F.lit(" "), F.lit("_")) for k in key))
    return F.concat(head, *(F.concat(F.lit(f" |{n} "), F.coalesce(c, F.lit(""))) for n, c in namespaces.items()))


def vw_fields(line: Column, names: list[str]) -> list[Column]:
    """The key's parts of such a line."""
    parts = F.split(F.split_part(line, F.lit(" |"), F.lit(1)), r"\*")
    return [F.get(parts, i).alias(n) for i, n in enumerate(names)]


def overwrite_partitions(df: DataFrame, path: str, *keys: str) -> None:
    """Replace only the partitions that ``df`` has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def with_normal_url(df: DataFrame, records: DataFrame, url: str = "url", redirect: str = "redirect_url") -> DataFrame:
    """Records found by normalised url, else by the redirect's."""
    r = records.select(url_key(F.col("url")).alias("k"), F.col("record_id"))
    out = df.withColumn("k1", url_key(F.col(url))).withColumn("k2", url_key(F.col(redirect)))
    out = out.join(r.toDF("k1", "r1"), "k1", "left").join(r.toDF("k2", "r2"), "k2", "left")
    return out.withColumn("record_id", F.coalesce("r1", "r2")).drop("k1", "k2", "r1", "r2")
