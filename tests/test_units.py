"""Pooling of nested units against plain loops, and models in batches."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import units

UNIT = "struct<unit: string, vector: array<float>>"


def pool(vectors, how):
    if not vectors:
        return None
    v = np.array(vectors, float)
    return [*v.mean(0)] * (how != "Max") + [*v.max(0)] * (how != "Average")


def words(sentence):
    groups = []
    for name, vec in sentence[1:-1]:
        if groups and "##" in name:
            groups[-1][0] += name.replace("##", "")
            groups[-1][1].append(vec)
        else:
            groups.append([name, [vec]])
    return [(name, pool(v, "Average")) for name, v in groups]


def sentence(ws, how):
    return "".join(n.replace("##", "") + " " for n, _ in ws[1:-1]), pool([v for _, v in ws[1:-1]], how)


def text(ss, how):
    return "".join(n + " " for n, _ in ss), pool([v for _, v in ss if v is not None], how)


def same(got, want):
    assert got["unit"] == want[0] and (got["vector"] is None) == (want[1] is None)
    assert want[1] is None or np.allclose(got["vector"], want[1])


@pytest.mark.parametrize("how", units.POOLINGS)
def test_pooling(spark, how):
    rng = random.Random(6)
    piece = lambda: (rng.choice(["a", "##b", "c##d", "é", ""]), [rng.randrange(-8, 8) / 4 for _ in range(3)])
    texts = [[[piece() for _ in range(rng.randrange(9))] for _ in range(rng.randrange(5))] for _ in range(40)] + [[[piece() for _ in range(20_000)]], []]
    df = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], f"i int, t array<array<{UNIT}>>").withColumn("unit", F.lit("clash"))
    df = df.repartition(3)
    w = units.to_words(df, "t")
    u = units.to_sentences(w, "t", how)
    got = [{r["i"]: r["t"] for r in x.collect()} for x in (w, u, units.to_text(u, "t"))]
    assert got[0][99] == got[1][99] == [] and got[2][99]["unit"] == "" and got[2][99]["vector"] is None
    for i, t in enumerate(texts):
        ws = [words(s) for s in t]
        ss = [sentence(x, how) for x in ws]
        for g, x in [*((g, x) for gs, xs in zip(got[0][i], ws, strict=True) for g, x in zip(gs, xs, strict=True)), *zip(got[1][i], ss, strict=True), (got[2][i], text(ss, "Average"))]:
            same(g, x)
    assert units.to_text(units.to_sentences(units.to_words(df.limit(0), "t"), "t", how), "t").count() == 0


def test_pooling_names():
    with pytest.raises(ValueError, match="pooling"):
        units.pooled(np.zeros((1, 1)), np.ones(1), "Median")


@pytest.mark.parametrize("size", [1, 7, 25, 1000])
def test_models_in_batches(spark, size):
    df = spark.createDataFrame([(i, f"t{i}" if i % 9 else None, 1) for i in range(103)], "i int, text string, vector int").coalesce(1)

    def load():
        calls = []

        def model(texts):
            calls.append(len(texts))
            return [[float(len(calls)), float(len(texts)), float(len(t or ""))] for t in texts]

        return model

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        rows = sorted(units.applied(df, load, "text", "vector", "array<double>", size).collect(), key=lambda r: r["i"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r["i"] for r in rows] == list(range(103))  # the ragged last batch stays
    assert [r["vector"] for r in rows] == [[i // size + 1.0, float(min(size, 103 - i // size * size)), float(len(f"t{i}") if i % 9 else 0)] for i in range(103)]
    assert units.applied(df.limit(0), load, "text", "vector", "array<double>", size).count() == 0
    with pytest.raises(Exception, match="the model gave"):
        units.applied(df, lambda: lambda texts: texts[1:], "text", "v", "string", size).collect()
