"""Topic weights, topic words and expert marks derived from the driver's tables, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import NOT_WORD, cleaned_words
from tidemark.operators.dictionary import dealt, dealt_rows
from tidemark.scratch import stored


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").withColumnRenamed("lang", "corpus")


def theta(spark: SparkSession, d: str) -> DataFrame:
    """document_id, topic_id, topic_weight; the weights of a document add to 1. Its items are shuffled once, into parts of a fixed size."""
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("document_id"), (F.col("l_partkey") % 20).alias("t"), "l_quantity")
    per = dealt_rows(items, "document_id").groupBy("document_id", "t").agg(F.sum("l_quantity").alias("q"))
    total = F.sum("q").over(Window.partitionBy("document_id"))
    return per.select("document_id", F.concat(F.lit("topic_"), F.col("t")).alias("topic_id"), (F.col("q") / total).alias("topic_weight"))


def theta_dt(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("document_id"), F.col("o_orderdate").alias("datetime"), F.col("o_orderpriority").alias("source"), F.col("o_orderstatus").alias("corpus")
    )
    return theta(spark, d).join(o, "document_id")


def doc_words(spark: SparkSession, d: str, least: int = 3) -> DataFrame:
    """doc_id, topic_id, word, tf of each document's words of ``least`` letters or more."""
    w = dealt(docs(spark, d).select("doc_id", "source", "text"), "doc_id", "text")  # so that a document's words stay where they are
    w = w.select("doc_id", F.concat(F.lit("topic_"), F.expr("substr(source, 4)")).alias("topic_id"), F.explode(cleaned_words(F.col("text"))).alias("word"))
    return w.where(F.length("word") >= least).groupBy("doc_id", "topic_id", "word").agg(F.count("*").alias("tf"))


def phi(spark: SparkSession, d: str, counted: DataFrame | None = None) -> DataFrame:
    """topic_id, word, tf, weight; the weights of a topic add to 1. The totals are a row for each topic. ``counted``:
    ``doc_words`` that a query has stored."""
    per = (doc_words(spark, d) if counted is None else counted).groupBy("topic_id", "word").agg(F.sum("tf").alias("tf"))
    per = stored(per, "phi")
    total = per.groupBy("topic_id").agg(F.sum("tf").alias("total"))
    return per.join(F.broadcast(total), "topic_id").select("topic_id", "word", "tf", (F.col("tf") / F.col("total")).alias("weight"))


def topic_eval(spark: SparkSession, d: str) -> DataFrame:
    """topic_id, author, value of three experts; two of the twenty topics have none."""
    return table(spark, d, "part").select(
        F.concat(F.lit("topic_"), F.col("p_partkey") % 20).alias("topic_id"),
        (F.col("p_partkey") % 3).alias("author"),
        (((F.col("p_partkey") * 37) % 201 - 100) / F.lit(100.0) * F.lit(0.5) + F.when(F.col("p_partkey") % 3 == 0, 0.25).otherwise(F.col("p_partkey") % 20 / 40.0 - 0.25)).alias("value"),
    ).where("topic_id not in ('topic_7', 'topic_13')")


# The same in SQL ------------------------------------------------------------------------------------------------------

Q6 = "(floor(cast({} as double)*1e6 + 0.50001)/1e6)"
WORDS_SQL = f"list_filter(string_split(lower(regexp_replace(text, '{NOT_WORD}', ' ', 'g')), ' '), lambda x: x <> '')"
THETA_SQL = """theta as (select document_id, 'topic_' || t as topic_id, q / sum(q) over (partition by document_id) as topic_weight from
 (select l_orderkey as document_id, l_partkey % 20 as t, sum(l_quantity) as q from lineitem group by 1, 2))"""
THETA_DT_SQL = THETA_SQL + """, theta_dt as (select theta.*, o_orderdate as datetime, o_orderpriority as source, o_orderstatus as corpus
 from theta join orders on o_orderkey = document_id)"""
DOC_WORDS_SQL = f"""doc_words as (select doc_id, topic_id, word, count(*) as tf from (select doc_id, 'topic_' || substr(source, 4) as topic_id,
 unnest({WORDS_SQL}) as word from documents) where length(word) >= 3 group by 1, 2, 3)"""
PHI_SQL = DOC_WORDS_SQL + """, phi as (select topic_id, word, tf, tf / sum(tf) over (partition by topic_id) as weight from
 (select topic_id, word, cast(sum(tf) as bigint) as tf from doc_words group by 1, 2))"""
EVAL_SQL = """topic_eval as (select 'topic_' || (p_partkey % 20) as topic_id, p_partkey % 3 as author, ((p_partkey * 37) % 201 - 100) / 100.0::double * 0.5::double + case when p_partkey % 3 = 0 then 0.25::double else p_partkey % 20 / 40.0::double - 0.25::double end as value
 from part where p_partkey % 20 not in (7, 13))"""


def q6(x: str) -> str:
    return Q6.format(x)
