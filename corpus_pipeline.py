"""The corpus pipeline: quality rules, near duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir) and gets what its predecessor kept, read back from Parquet.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, contamination, jaccard, packing, quality, secret_scan

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def with_rows(docs: DataFrame) -> DataFrame:
    """The pipeline's columns and ``row``, a hash of where a row stands in its file: the same in every scan, whatever the
    partitions. Frames that are no scan of files are written first."""
    try:
        place = docs.metadataColumn("_metadata")
        return docs.select(*COLUMNS, F.xxhash64(place["file_path"], place["row_index"]).alias("row"))
    except AnalysisException:
        return with_rows(common.stored(docs.select(*COLUMNS), "rows"))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not in ``gone`` (doc_id, row); a null id equals a null id."""
    out = gone.select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row"))
    on = (F.col("row") == F.col("gone_row")) & F.col("doc_id").eqNullSafe(F.col("gone_id"))
    return docs.join(out, on, "left_anti").select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Each row is judged by its own text, so of rows with one id some may stay; null and empty texts fail the base rule; a
    row with a null id is judged like others but is nobody's label. Empty table: no rows. Further columns go.
    """
    rows = with_rows(docs)
    verdict = quality.judge(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), row_col="row")
    return without(rows, verdict.where("not kept").select("doc_id", "row"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: five words a shingle, similarity 0.8 or more.

    The row with the least doc_id stays, a null one only if the component has no other; of rows with the same id, one.
    Repeated rows are copies of each other. Texts without words link with nothing and stay, as do null ones. Empty table:
    no rows. Further columns go.
    """
    rows = with_rows(docs)
    found = jaccard.near_duplicates(rows.drop("doc_id"), n=5, percent=80, id_col="row").select(F.col("doc_id").alias("row"), "component_id")
    named = rows.select("doc_id", "row").join(found.distinct(), "row")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    kept = named.groupBy("component_id").agg(F.min(order).alias("least")).select("least.doc_id", "least.row", F.lit(True).alias("kept"))
    gone = named.join(kept, named["row"].eqNullSafe(kept["row"]) & named["doc_id"].eqNullSafe(kept["doc_id"]), "left_anti")
    return without(rows, gone)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; items under 40 characters are no evidence to drop a document.

    Each row is searched in its own text, so of rows with one id some may go, and a null id protects none. Null and empty
    texts stay. Empty tables: nothing goes. Further columns go.
    """
    rows = with_rows(docs)
    leaks = contamination.find_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="row", short=False)
    return rows.join(leaks.select(F.col("doc_id").alias("row")).distinct(), "row", "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced by a mark; n_chars follows the text, and stays where the text is null. All rows stay, each treated
    for itself, whatever its id. Further columns go."""
    changed = secret_scan.redact(docs.select(*COLUMNS))
    return changed.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, with its sequence and offset. Rows with one id are documents of their own, a
    null id stays null, a null or empty text is the end token alone. Empty table: no rows. Other columns are not read."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), spaced=False, end_id=2)


STAGES = [
    ("quality_rules", keep_quality),
    ("ngram_jaccard", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("secret_scan", redact_secrets),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
