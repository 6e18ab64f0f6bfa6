"""Topic models by name: saved, found and loaded again.

A registry is a folder with a table of models and one of their words' weights, both partitioned by name, so that saving a
model replaces that model alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import sharded
from tidemark.operators.artm import Model
from tidemark.sources.files import overwrite_partitions

INFO = "name string, corpus string, number_of_topics int, number_of_documents long, perplexity double, is_ready boolean"
PHI = "name string, word string, place int, weights array<double>"


def save(spark: SparkSession, path: str, name: str, model: Model, corpus: str = "", documents: int = 0, ready: bool = True) -> None:
    """Words first, then the entry that makes the model known."""
    rows = [(name, w, i, model.phi[i].tolist()) for i, w in enumerate(model.words)]
    overwrite_partitions(spark.createDataFrame(rows, PHI), f"{path}/phi", "name")
    last = float(model.perplexity[-1]) if model.perplexity else None
    entry = spark.createDataFrame([(name, corpus, model.phi.shape[1], documents, last, ready)], INFO)
    overwrite_partitions(entry, f"{path}/models", "name")


def save_sharded(spark: SparkSession, path: str, name: str, model: sharded.Model, corpus: str = "", documents: int = 0, ready: bool = True) -> None:
    """A model whose weights are a table; they are written from where they lie."""
    rows = model.rows().select(F.lit(name).alias("name"), "word", "place", "weights")
    overwrite_partitions(rows, f"{path}/phi", "name")
    last = float(model.perplexity[-1]) if model.perplexity else None
    entry = spark.createDataFrame([(name, corpus, len(model.totals), documents, last, ready)], INFO)
    overwrite_partitions(entry, f"{path}/models", "name")


def load_sharded(spark: SparkSession, path: str, name: str) -> sharded.Model:
    """A saved model of any size, its weights left where they lie."""
    entry = find(spark, path, name)
    rows = spark.read.schema(PHI).parquet(f"{path}/phi").where(F.col("name") == name).select("word", "place", "weights")
    return sharded.Model.of_rows(rows, entry["number_of_topics"], [] if entry["perplexity"] is None else [entry["perplexity"]])


def models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INFO).parquet(f"{path}/models")


def find(spark: SparkSession, path: str, name: str) -> dict:
    """The entry of a ready model; KeyError without one."""
    found = models(spark, path).where((F.col("name") == name) & F.col("is_ready") & (F.col("number_of_topics") > 0)).first()
    if found is None:
        raise KeyError(name)
    return found.asDict()


def load(spark: SparkSession, path: str, name: str) -> Model:
    """The model as it was saved; its size is bounded as in fitting."""
    entry = find(spark, path, name)
    rows = spark.read.schema(PHI).parquet(f"{path}/phi").where(F.col("name") == name).orderBy("place").select("word", "weights").toArrow()
    weights = np.array(rows["weights"].to_pylist(), float).reshape(rows.num_rows, entry["number_of_topics"])
    return Model(rows["word"].to_pylist(), weights, [] if entry["perplexity"] is None else [entry["perplexity"]])
