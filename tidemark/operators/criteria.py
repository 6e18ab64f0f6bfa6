"""Scoring documents by expert criteria over their topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import min_max
from tidemark.operators.quantiles import quantiles
from tidemark.operators.topics import topic_index

#: Keeps odds finite.
TINY = 2.0**-20


def marks(evals: DataFrame) -> DataFrame:
    """Mean expert value of each topic."""
    return evals.groupBy("topic_id").agg(F.avg("value").alias("mark"))


def _marked(theta: DataFrame, m: DataFrame, low: float, negative: bool, least: float, most: int) -> DataFrame:
    """Each document's ``most`` heaviest topics with their marks, 0 where none was given. ``negative`` then turns the mark
    round: its sign on a scale from below 0, else to what is left of 1 (so that a topic without a mark counts 1)."""
    rank = F.row_number().over(Window.partitionBy("document_id").orderBy(F.desc("topic_weight"), "topic_id"))
    x = theta.where(F.col("topic_weight") >= least).withColumn("rank", rank).where(F.col("rank") <= most)
    mark = F.coalesce("mark", F.lit(0.0))
    if negative:
        mark = -mark if low < 0 else 1.0 - mark
    return x.join(m, "topic_id", "left").withColumn("mark", mark)


def evaluate(theta: DataFrame, m: DataFrame, low: float = -1.0, negative: bool = False, least: float = 0.001, most: int = 50) -> DataFrame:
    """document_id, value: mean mark of the document's topics by weight, on a scale from ``low``."""
    x = _marked(theta, m, low, negative, least, most)
    return x.groupBy("document_id").agg((F.sum(F.col("topic_weight") * F.col("mark")) / F.sum("topic_weight")).alias("value"), F.count("*").alias("n_topics"))


def extremes(theta: DataFrame, m: DataFrame, low: float = -1.0, high: float = 1.0, negative: bool = False, least: float = 0.001, most: int = 50, k: int = 3) -> DataFrame:
    """document_id, topic_ids_top, topic_ids_bottom: the k largest contributions over, and the k smallest under, the
    neutral band. On a scale from below 0 the band is 0.1 around its centre; a scale from 0 has a band up to 0.001 and
    no bottom."""
    centre, near = ((low + high) / 2, 0.1) if low < 0 else (0.0, 0.001)
    x = _marked(theta, m, low, negative, least, most).withColumn("part", F.round(F.col("topic_weight") * F.col("mark"), 12))
    by = Window.partitionBy("document_id")
    x = x.withColumn("t", F.row_number().over(by.orderBy(F.desc("part"), "topic_id"))).withColumn("b", F.row_number().over(by.orderBy("part", "topic_id")))
    names = lambda rank, ok: F.transform(F.array_sort(F.collect_list(F.when(ok & (F.col(rank) <= k), F.struct(rank, "topic_id")))), lambda s: s["topic_id"])
    under = F.col("part") < centre - near if low < 0 else F.lit(False)
    return x.groupBy("document_id").agg(names("t", F.col("part") > centre + near).alias("topic_ids_top"), names("b", under).alias("topic_ids_bottom"))


def by_documents(theta: DataFrame, examples: DataFrame) -> DataFrame:
    """Topic marks from example documents: mean of non-zero weights, scaled to [0, 1] over the topics."""
    x = theta.join(examples, "document_id", "left_semi").groupBy("topic_id").agg(F.avg(F.when(F.col("topic_weight") != 0, F.col("topic_weight"))).alias("v"))
    every = theta.select("topic_id").distinct().join(x, "topic_id", "left").withColumn("v", F.coalesce("v", F.lit(0.0)))
    ends = every.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    return every.crossJoin(F.broadcast(ends)).select("topic_id", min_max(F.col("v"), F.col("lo"), F.col("hi")).alias("mark"))


def word_scores(phi: DataFrame, m: DataFrame) -> DataFrame:
    """sign, topic_id, word, score: weight * mark of words of marked topics, scaled by sign to (0, 1] or [-1, 0)."""
    x = phi.join(m.where("mark <> 0"), "topic_id").withColumn("raw", F.col("weight") * F.col("mark")).withColumn("sign", F.signum("mark").cast("int"))
    ends = x.groupBy("sign").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"))  # two rows at most
    x, lo, hi = x.join(F.broadcast(ends), "sign"), F.col("lo"), F.col("hi")
    score = F.when(F.col("sign") > 0, min_max(F.col("raw"), lo, hi, 1e-6, 1.0)).otherwise(min_max(F.col("raw"), lo, hi, -1.0, -1e-6))
    return x.select("sign", "topic_id", "word", score.alias("score"))


def first_matrix(topics: DataFrame, evals: DataFrame, negate: bool = False) -> DataFrame:
    """p1 column: for every topic sum / (count + 1) of its values (a 0 counts in), negated if asked, scaled to [0, 1]."""
    v = F.sum("value") / (F.count("*") + 1)
    x = topics.join(evals.groupBy("topic_id").agg((-v if negate else v).alias("v")), "topic_id", "left").withColumn("v", F.coalesce("v", F.lit(0.0)))
    ends = x.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    return x.crossJoin(F.broadcast(ends)).select("topic_id", min_max(F.col("v"), F.col("lo"), F.col("hi")).alias("p"))


def odds(p: Column, w: Column) -> Column:
    v = (p - 0.5) * w + 0.5 + TINY
    return v / (1 - v)


def fuse(pairs: DataFrame, keys: list[str], inner: int) -> DataFrame:
    """Bayes product over an inner index of size ``inner``: odds multiply; an absent pair has weight 0, a constant."""
    rest = F.pow(F.lit((0.5 + TINY) / (0.5 - TINY)), F.lit(inner) - F.count("*"))
    o = F.product(odds(F.col("p"), F.col("w"))) * rest
    return pairs.groupBy(*keys).agg(o.alias("o")).select(*keys, (F.col("o") / (1 + F.col("o"))).alias("score"))


def document_scores(theta: DataFrame, p1: DataFrame, topics: int) -> DataFrame:
    """document_id, score (p6): fused over the document's topics."""
    x = theta.join(p1, "topic_id").select("document_id", "p", F.col("topic_weight").alias("w"))
    return fuse(x, ["document_id"], topics)


def classes(p1: DataFrame, p3: DataFrame, criteria: int) -> DataFrame:
    """topic_id, class_id, p (p4): ``p1`` topic_id, criterion_id, p as weights; ``p3`` criterion_id, class_id, weight as
    probabilities."""
    x = p1.select("topic_id", "criterion_id", F.col("p").alias("w")).join(p3.select("criterion_id", "class_id", F.col("weight").alias("p")), "criterion_id")
    return fuse(x, ["topic_id", "class_id"], criteria).withColumnRenamed("score", "p")


def document_classes(theta: DataFrame, p4: DataFrame, topics: int) -> DataFrame:
    """document_id, class_id, score (p5)."""
    x = theta.join(p4, "topic_id").select("document_id", "class_id", F.col("topic_weight").alias("p"), F.col("p").alias("w"))
    return fuse(x, ["document_id", "class_id"], topics)


def thresholds(values: DataFrame, low: float, high: float, value: str = "value") -> DataFrame:
    """Exact percentiles of a column: low_at, high_at, one row; see ``quantiles`` for how and for nulls."""
    return values.sparkSession.createDataFrame([tuple(quantiles(values, value, [low, high]))], "low_at double, high_at double")


def report(theta: DataFrame, m: DataFrame, limits: DataFrame, kind: int, least_topics: int = 0) -> DataFrame:
    """document_id, value: documents to alert on; value is the sum of weight * mark over marked topics.

    ``limits`` has one row: value_at and weight_at, percentiles of the corpus' values and topic weights. A document needs
    ``least_topics`` topics of weight_at or more; kind 1 keeps those over value_at, -1 those under it, 0 all.
    """
    relevant = F.count_if(F.round("topic_weight", 9) >= F.round("weight_at", 9))
    x = theta.crossJoin(F.broadcast(limits)).join(m, "topic_id", "left")
    x = x.groupBy("document_id").agg(
        F.coalesce(F.sum(F.col("topic_weight") * F.col("mark")), F.lit(0.0)).alias("value"), relevant.alias("relevant"), F.first("value_at").alias("value_at")
    )
    test = {1: F.col("value") > F.col("value_at"), -1: F.col("value") < F.col("value_at"), 0: F.lit(True)}[kind]
    return x.where(test & (F.col("relevant") >= least_topics)).select("document_id", "value")


__all__ = ["topic_index", "marks", "evaluate", "extremes", "by_documents", "word_scores", "first_matrix", "fuse", "document_scores", "classes", "document_classes", "thresholds", "report"]
