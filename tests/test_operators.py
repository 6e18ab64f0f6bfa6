"""Operators against small literals and plain restatements."""

import glob
import math
import os
import random
import statistics
import time
from collections import Counter
from datetime import date, datetime, timedelta

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import artm, clusters, criteria, dictionary, dynamics, frequent, graph, posts, relational, similarity, topics, wordpiece
from tidemark.sources import files
from tidemark.streaming import feeds, windows


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, want",
    [("Ёжик Нұр-Сұлтан 12%", "жик нұр-сұлтан"), ("ab*cd ef", "ef"), ("*cd ef", "cd ef"), ("ab\nc*d e", "e"), ("", ""), (None, None)],
)
def test_clean(spark, text, want):
    assert one(spark, text, c.clean) == want


def test_clean_equals_the_pattern(spark):
    import re

    rng = random.Random(3)
    texts = ["".join(rng.choice("ab *-\n1Ёж*  ") for _ in range(rng.randint(0, 40))) for _ in range(5000)] + ["x" * 200_000 + "*", "*x" * 50_000, "a" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", c.clean(F.col("t")).alias("x"))
    for i, x in df.collect():
        old = texts[i] if len(texts[i]) > 1000 else re.sub(c.NOT_WORD, " ", texts[i])
        assert x == ("" if "*x" in texts[i][:9] and len(old) > 1000 else "" if old.endswith("x*") and len(old) > 1000 else " ".join(w for w in old.lower().split(" ") if w))


def test_flags_of_nothing(spark):
    row = spark.createDataFrame([("",)], "t string").select(c.is_word(F.col("t")), c.is_kazakh(F.col("t")), c.is_latin(F.col("t"))).first()
    assert tuple(row) == (False, False, False)


def test_ngrams(spark):
    x = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>").select(c.ngrams(F.col("t"), 2).alias("g")).collect()
    assert [r["g"] for r in x] == [["a_b", "b_c"], [], []]


def test_slug_and_codes(spark):
    assert one(spark, "Щука Әлем 1", c.slug) == "shchuka_lem_1"
    row = spark.range(1).select(c.code_to_id(c.id_to_code(F.lit(123456789012))).alias("x"), c.id_to_code(F.lit(0)).alias("z")).first()
    assert (row["x"], row["z"]) == (123456789012, "A")


def test_bayes_over_one(spark):
    v = [1 + 2**-20, 0.4]
    odds = math.prod(x / (1 - x) for x in v)
    got = spark.createDataFrame([(1.0, 1.0), (0.4, 1.0)], "p double, w double")
    x = got.groupBy().agg(F.product(criteria.odds(F.col("p"), F.col("w"))).alias("o")).first()["o"]
    fold = math.prod((((p - 0.5) * 1 + 0.5 + 2**-20) / (1 - ((p - 0.5) * 1 + 0.5 + 2**-20))) for p in (1.0, 0.4))
    assert x == pytest.approx(fold) and odds / (1 + odds) == pytest.approx(1.0000014305, abs=1e-9)


def test_periods_against_a_state_machine(spark):
    rng, rows = random.Random(7), []
    for t in range(40):
        for i in range(rng.randint(2, 30)):
            rows.append((f"t{t}", date(2024, 1, 1) + timedelta(i), rng.choice([0.25, 0.5, 1.0, rng.random() + 0.01])))
    s = spark.createDataFrame(rows, "topic_id string, day date, weight_share double")
    got = sorted((r["topic_id"], r["period_start"], r["period_length"]) for r in dynamics.periods(s).collect())
    want = []
    for t in {r[0] for r in rows}:
        w = [r[2] for r in rows if r[0] == t]
        g, m, sd = round(math.exp(statistics.fmean(map(math.log, w))), 12), statistics.fmean(w), statistics.pstdev(w)
        start = top = None
        for i, x in enumerate(w):
            r = round(x, 12)
            if r > g and start is None:
                start, top = i, None
            elif r < g and start is not None:
                if top - m > 0.5 * sd:
                    want.append((t, start, i - start))
                start = None
            if start is not None:
                top = x if top is None else max(top, x)
    assert got == sorted(want)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_of_hubs(spark):
    hubs = [(7, 1000 + i) for i in range(600)] + [(5000, 3000 + i) for i in range(600)] + [(9000 + i, 9001 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(hubs + [(1599, 8), (20, 21)], "u long, v long")).collect()}
    want = {7: 7, 8: 7, 5000: 3000, 20: 20, 21: 20} | {1000 + i: 7 for i in range(600)} | {3000 + i: 3000 for i in range(600)} | {9000 + i: 9000 for i in range(41)}
    assert got == want


def test_dbscan_border_and_noise(spark):
    d = spark.createDataFrame([(1, 2, 0.1), (1, 3, 0.1), (2, 3, 0.1), (3, 4, 0.1), (6, 7, 0.1)], "a long, b long, distance double")
    pts = spark.createDataFrame([(i,) for i in range(1, 9)], "point long")
    got = {r["point"]: r["label"] for r in clusters.dbscan(d, pts, 0.2, 3).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 0, 5: -1, 6: -1, 7: -1, 8: -1}


def test_equal_sources_are_compared_once(spark, tmp_path, monkeypatch):
    """Sources whose vectors are the same but for a factor are one weighted point; labels as over all pairs."""
    from tidemark.plans import similarity as plans

    shapes = [{"a": 9}, {"a": 9, "b": 1}, {"a": 1, "b": 9}, {"b": 4}, {"c": 2, "d": 2}, {"c": 1, "d": 1}, {"d": 5, "a": 1}, {"e": 1}]
    events = [(u, t) for u in range(100) for t, n in shapes[u % 6 if u < 96 else 6 + u % 2].items() for _ in range(n)]
    spark.createDataFrame(events, "user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    met, plain = [], plans.cosine.similar_pairs
    monkeypatch.setattr(plans.cosine, "similar_pairs", lambda v, t: met.append(v.select("row").distinct().count()) or plain(v, t))
    got = {r["point"]: r["label"] for r in plans.source_dbscan(spark, str(tmp_path)).collect()}
    x = np.array([[shapes[u % 6 if u < 96 else 6 + u % 2].get(c, 0) for c in "abcde"] for u in range(100)], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = np.floor((1 - x @ x.T) * 1e9 + 0.5) / 1e9 <= 0.01
    core, want = near.sum(axis=1) >= 4, np.full(100, -1)
    for p in range(100):
        if core[p] and want[p] < 0:
            stack, label = [p], want.max() + 1
            while stack:
                q = stack.pop()
                if want[q] < 0:
                    want[q] = label
                    stack += np.flatnonzero(near[q] & core & (want < 0)).tolist() if core[q] else []
    for p in np.flatnonzero(~core):
        want[p] = min((want[q] for q in np.flatnonzero(near[p] & core)), default=-1)
    assert got == dict(enumerate(want.tolist())) and met == [7]


@pytest.mark.parametrize("most", [10**9, 0])
def test_source_dbscan_like_sql(spark, tmp_path, monkeypatch, most):
    """By a table of pairs and by blocks: many clusters, border points, events without a type and without a source."""
    from tidemark.plans import similarity as plans

    monkeypatch.setattr(plans, "MOST_PAIRED", most)
    monkeypatch.setattr(plans.density, "BLOCK", 16)
    rng = np.random.default_rng(1)
    kinds = [rng.dirichlet(np.full(8, 0.4)) for _ in range(12)]
    events = [(u, "abcdefgh"[k]) for u in range(240) for k in rng.choice(8, size=rng.integers(2, 30), p=kinds[u % 12])]
    events += [(u, None) for u in (3, 3, 17, 300)] + [(None, "a"), (None, None)]
    spark.createDataFrame(events, "user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(map(str, map(tuple, plans.source_dbscan(spark, str(tmp_path)).collect())))
    want = duckdb.sql(plans.ORACLES["source_dbscan"].replace("from events", f"from '{tmp_path}/events.parquet/*.parquet'")).fetchall()
    assert got == sorted(map(str, want)) and len({label for _, label in want}) > 4


def test_density_is_dbscan(spark, monkeypatch):
    """Against the method as published: seeds in order, each core point's neighbours in turn, a border point to the first."""
    from tidemark.operators import density

    monkeypatch.setattr(density, "BLOCK", 25)
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(rng.normal(size=3), 0.12, size=(30, 3)) for _ in range(9)] + [np.zeros((2, 3))])
    rows = [(int(i), v.tolist(), 0.0, 1) for i, v in enumerate(x)]
    norm = np.linalg.norm(x, axis=1)
    with np.errstate(all="ignore"):
        near = (np.floor((1 - x @ x.T / (norm[:, None] * norm)) * 1e9 + 0.5) / 1e9 <= 0.002) | np.eye(len(x), dtype=bool)
    want, n = np.full(len(x), -1), 0
    for p in range(len(x)):
        if want[p] < 0 and near[p].sum() >= 4:
            todo, want[p] = [p], n
            for q in todo:
                if near[q].sum() >= 4:
                    new = np.flatnonzero(near[q] & (want < 0)).tolist()
                    want[new] = n
                    todo += new
            n += 1
    got = density.dbscan(spark.createDataFrame(rows, "point long, vec array<double>, own double, weight long"), 0.002, 4).collect()
    assert [label for _, label in sorted(map(tuple, got))] == want.tolist() and n > 4 and -1 in want
    assert density.dbscan(spark.createDataFrame([], "point long, vec array<double>, own double, weight long"), 0.002, 4).count() == 0


def test_dbscan_weights(spark):
    """A point that stands for many is core by itself, in forests, in components and where all are neighbours."""
    d = spark.createDataFrame([(1, 2, 0.1), (3, 4, 0.1)], "a long, b long, distance double")
    pts = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, None), (5, 3)], "point long, weight long")
    want = [(1, 0), (2, 0), (3, -1), (4, -1), (5, 1)]
    assert sorted(map(tuple, clusters.dbscan(d, pts, 0.2, 3).collect())) == want
    got = clusters._grid_by_components(d, clusters._weighed(pts), [(0.2, 3)])
    assert sorted((r["point"], r["label"]) for r in got.collect()) == want
    got = clusters.dbscan_grid(d, pts, [(0.2, 3), (1.0, 8), (1.0, 9)], unlisted=1.0).collect()
    assert {(r["cell"], r["label"]) for r in got if r["cell"]} == {(1, 0), (2, -1)}


def test_clot_growth():
    dm = np.array([[0, 0.1, 0.2, 0.9], [0.1, 0, 0.5, 0.9], [0.2, 0.5, 0, 0.9], [0.9, 0.9, 0.9, 0]])
    assert clusters.grow(dm, 0.3, 0) == [0, 1]
    assert clusters.grow(dm, 0.6, 0) == [0, 1, 2]


def test_nearest_in_blocks(spark):
    rng = np.random.default_rng(4)
    v = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(60)], "vec_id long, embedding array<double>")
    rows = lambda most: sorted(map(tuple, similarity.nearest(v, v.where("vec_id % 3 = 0"), 3, most_queries=most).collect()))
    assert rows(7) == rows(20) and len(rows(7)) == 60


def test_nearest_equals_sums_of_every_pair(spark, tmp_path):
    """Against SQL: copies in large groups, vectors of zeros, of no or null components, and shorter ones."""
    rng = np.random.default_rng(5)
    vecs = [rng.normal(size=6).round(3).tolist() for _ in range(300)] + [[0.5, 0.25, 0.0, 0.0, 0.0, 1.0]] * 40 + [[0.0] * 6, None, [], [None] * 6, [None, 1.0, 2.0], [1e-9] * 6]
    v = spark.createDataFrame([(i * 7 % 349, x) for i, x in enumerate(vecs)], "vec_id long, embedding array<float>").repartition(3)
    v.write.parquet(f"{tmp_path}/embeddings.parquet")
    from tidemark.plans import similarity as plans

    got = plans.embedding_cosine(spark, str(tmp_path)).collect()
    sql = plans.ORACLES["embedding_cosine"].replace("from embeddings", f"from '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, duckdb.sql(sql).fetchall()))


def test_every_embedding_asks(spark, tmp_path):
    """All rows are queries, in several chunks; one without components is equally far from all, whatever their chunk."""
    from tidemark.plans import similarity as plans

    rng = np.random.default_rng(6)
    vecs = [rng.normal(size=3).round(2).tolist() for _ in range(90)] + [None] * 7 + [[0.0] * 3] * 6
    v = spark.createDataFrame([(i * 11 % 103, x) for i, x in enumerate(vecs)], "vec_id long, embedding array<float>").repartition(6)
    v.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = plans.embedding_cosine(spark, str(tmp_path)).collect()
    sql = plans.ORACLES["embedding_cosine"].replace("from embeddings", f"from '{tmp_path}/embeddings.parquet/*.parquet'")
    assert len(got) == 5 * 103 and sorted(map(str, map(tuple, got))) == sorted(map(str, duckdb.sql(sql).fetchall()))


def test_nearest_of_many_rows_in_time(spark):
    """150 million pairs; summing every pair component by component took minutes."""
    v = spark.range(55_000).select(F.col("id").alias("vec_id"), F.array(*(F.rand(i) - 0.5 for i in range(64))).cast("array<float>").alias("embedding")).localCheckpoint()
    began = time.time()
    assert similarity.nearest(v, v.where("vec_id % 20 = 0"), 5).count() == 5 * 2750
    assert time.time() - began < 60


def test_greedy_combos(spark):
    pairs = spark.createDataFrame([("a", "b", 9), ("a", "c", 5), ("a", "d", 1), ("b", "c", 4), ("b", "d", 3), ("c", "d", 2)], "topic_1 string, topic_2 string, common_docs long")
    # a sends its largest; b passes over a-b, which doesn't count, and sends b-c; c passes over b-c and sends a-c
    assert topics.greedy_combos(pairs, 9, 1) == [("a", "b", 9), ("b", "c", 4), ("a", "c", 5), ("b", "d", 3)]
    assert topics.greedy_combos(pairs, 4, 1) == [("a", "b", 9), ("a", "c", 5), ("b", "c", 4), ("c", "d", 2), ("b", "d", 3)]
    assert topics.greedy_combos(pairs, 0, 0) == [("a", "b", 9), ("a", "c", 5), ("a", "d", 1), ("b", "c", 4), ("b", "d", 3), ("c", "d", 2)]


def test_combos_need_unlike_words(spark):
    theta = spark.createDataFrame([(i, t, 0.5) for i in range(4) for t in "abc"] + [(9, "a", 0.09), (9, "b", 0.9)], "document_id long, topic_id string, topic_weight double")
    phi = spark.createDataFrame([("a", "x", 0.5), ("a", "y", 0.5), ("b", "x", 0.5), ("b", "y", 0.5), ("c", "z", 1.0)], "topic_id string, word string, weight double")
    found = topics.combos(theta, phi)
    assert sorted(map(tuple, found.collect())) == [("a", "c", 4), ("b", "c", 4)]
    assert topics.combo_documents(theta, found).count() == 8


def test_combo_documents_are_not_shuffled_again(spark):
    """Topic weights are evaluated once, in small splits; combinations are told to the documents where they stand."""
    from tidemark.plans import topics as plans

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = plans.topic_combo_documents(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "lineitem" not in plan and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    theta = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.4), (1, "c", 0.1), (2, "b", 0.5), (2, "a", 0.05), (None, "a", 0.9), (3, "a", 0.2), (3, "b", 0.2)], "document_id long, topic_id string, topic_weight double")
    pairs = spark.createDataFrame([("a", "b", 2), ("b", "c", 1)], "topic_1 string, topic_2 string, common_docs long")
    assert sorted(map(tuple, topics.combo_documents(theta, pairs).collect())) == [("a", "b", 1), ("a", "b", 3), ("b", "c", 1)]
    assert sorted(map(tuple, topics.common_documents(topics.document_topics(theta)).collect())) == [("a", "b", 2), ("a", "c", 1), ("b", "c", 1)]


def test_marks_on_a_scale_from_0(spark):
    theta = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.4)], "document_id long, topic_id string, topic_weight double")
    m = criteria.marks(spark.createDataFrame([("a", 1.0), ("a", 0.5)], "topic_id string, value double"))
    value = lambda **k: criteria.evaluate(theta, m, **k).first()["value"]
    assert value() == pytest.approx(0.45) and value(negative=True) == pytest.approx(-0.45)
    assert value(low=0.0, negative=True) == pytest.approx(0.6 * 0.25 + 0.4)  # the topic without a mark counts 1
    ends = lambda **k: tuple(criteria.extremes(theta, m, **k).select("topic_ids_top", "topic_ids_bottom").first())
    assert ends(low=0.0) == (["a"], []) and ends(low=0.0, negative=True) == (["b", "a"], [])
    assert ends() == (["a"], []) and ends(negative=True) == ([], ["a"])
    assert ends(low=-1.0, high=2.0) == ([], ["b"])  # centre 0.5: a's 0.45 is in the band


def test_alerts(spark):
    theta = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.4), (2, "a", 0.9), (3, "c", 0.5), (3, "b", 0.5)], "document_id long, topic_id string, topic_weight double")
    m = spark.createDataFrame([("a", 1.0), ("b", -1.0)], "topic_id string, mark double")
    limits = spark.createDataFrame([(0.1, 0.45)], "value_at double, weight_at double")
    ids = lambda kind, least=0: sorted(r["document_id"] for r in criteria.report(theta, m, limits, kind, least).collect())
    assert ids(1) == [1, 2] and ids(-1) == [3] and ids(0) == [1, 2, 3]
    assert ids(0, 2) == [3] and ids(1, 1) == [1, 2] and ids(1, 2) == []


def test_admission_order(spark):
    df = spark.createDataFrame([(1, "short", "x"), (1, "l" * 120, "x"), (2, "l" * 120, "x"), (3, "b", "some hate"), (None, "l" * 120, "x")], "doc_id long, text string, corpus string")
    got = relational.admit(df, gate=F.col("text") != "b")
    assert sorted((str(r["doc_id"]), len(r["text"])) for r in got.collect()) == [("1", 120), ("2", 120), ("None", 120)]  # equal texts stay
    assert relational.admit(df).where("doc_id = 3").count() == 1


def test_null_keys_are_numbered(spark):
    df = spark.createDataFrame([(None,), (70_000,), (5,), (None,), (140_000,)], "k long")
    got = sorted((r["row_number"], r["k"]) for r in relational.numbered(df, "k").collect())
    assert got == [(1, None), (2, None), (3, 5), (4, 70_000), (5, 140_000)]
    assert relational.percent_slice(df, "k", 0, 50).count() == 3


def test_search_and_dimension(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, s string")
    assert [r["k"] for r in relational.search(df, {"s__exists": True, "k__lte": 3}, sort=["-k"], end=1).collect()] == [3]
    dim = spark.createDataFrame([("x", 7)], "s string, id int")
    whole, facts = relational.with_dimension(df, dim, "s", "id")
    assert {(r["s"], r["id"]) for r in whole.collect()} == {("x", 7), ("y", 8)} and facts.where("s is null").first()["id"] is None


def test_undated_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, datetime(2020, 1, 1), "b")], "k int, datetime timestamp_ntz, corpus string")
    assert {r["k"] for r in relational.within_dates(df, datetime(2019, 1, 1), None, ["a"]).collect()} == {1, 3}
    assert relational.within_dates(df, None, None).count() == 3


# The published examples of the tokeniser.
def test_basic_tokens():
    assert wordpiece.basic(" \tHeLLo!how  \n Are yoU?  ") == ["hello", "!", "how", "are", "you", "?"]
    assert wordpiece.basic("Héllo") == ["hello"]
    assert wordpiece.basic("ah博推zz") == ["ah", "博", "推", "zz"]
    assert wordpiece.basic(" \tHeLLo!how  \n Are yoU?  ", lower=False) == ["HeLLo", "!", "how", "Are", "yoU", "?"]


def test_word_pieces():
    vocab = {w: i for i, w in enumerate(["[UNK]", "[CLS]", "[SEP]", "want", "##want", "##ed", "wa", "un", "runn", "##ing", ","])}
    assert wordpiece.pieces("unwanted", vocab) == ["un", "##want", "##ed"]
    assert wordpiece.pieces("unwantedX", vocab) == ["[UNK]"]
    assert wordpiece.pieces("", vocab) == []
    got = [p for w in wordpiece.basic("UNwantéd,running") for p in wordpiece.pieces(w, vocab)]
    assert [vocab[p] for p in got] == [7, 4, 5, 10, 8, 9]
    ids, mask = wordpiece.features(got, vocab, 10)
    assert ids == [1, 7, 4, 5, 10, 8, 9, 2, 0, 0] and sum(mask) == 8


def test_topic_model(spark):
    rows = [(d, w, 3) for d in range(20) for w in (("cat", "dog", "cow") if d % 2 else ("tax", "law", "vote"))]
    bow = spark.createDataFrame(rows, "doc_id long, word string, tf int")
    s = artm.Settings(topics=2, passes=8)
    m = artm.fit(bow, s)
    assert np.allclose(m.phi.sum(axis=0), 1) and all(a >= b - 1e-9 for a, b in zip(m.perplexity, m.perplexity[1:]))
    theta = artm.transform(bow, m, s)
    assert theta.groupBy("document_id").agg(F.round(F.sum("topic_weight"), 6).alias("s")).where("s > 0.999").count() == 20


def test_url_records(spark, tmp_path):
    (tmp_path / "r.txt").write_text("1\nhttp://a\n2020\ns1\n2\nhttp://b\n2021\ns2\n")
    got = sorted((r["id"], r["url"], r["source"]) for r in files.url_records(spark, f"file://{tmp_path}/r.txt").collect())
    assert got == [("1", "http://a", "s1"), ("2", "http://b", "s2")]


def test_word_vectors_and_json(spark, tmp_path):
    (tmp_path / "v.txt").write_text("a 1 2\nb 3 4\n")
    vocab = spark.createDataFrame([("a",), ("z",)], "word string")
    got = {r["word"]: r["vector"] for r in files.word_vectors(spark, f"file://{tmp_path}/v.txt", vocab).collect()}
    assert got["a"] == [1.0, 2.0] and len(got["z"]) == 2
    (tmp_path / "x.json").write_text('[{"id": 1}, {"id": 2}]')
    assert files.json_items(spark, f"file://{tmp_path}/x.json").count() == 2


def test_stream_equals_batch(spark, tmp_path):
    src = f"file://{tmp_path}/e"
    rows = [(datetime(2024, 1, 1) + timedelta(minutes=7 * i), "x", 1.0) for i in range(100)]
    spark.createDataFrame(rows, "ts timestamp, event_type string, value double").repartition(3).write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(src)
    q = windows.tumbling(stream, "1 hour").writeStream.outputMode("complete").format("memory").queryName("t").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(map(tuple, spark.table("t").collect()))
    assert got == sorted(map(tuple, windows.tumbling(spark.read.parquet(src), "1 hour").collect()))


def test_russian_dates(spark):
    cases = [
        ("Опубликовано: 5 марта 2021, 10:00 МСК", date(2021, 3, 5)), ("12 мая", date(2021, 5, 12)), ("3 декабря", date(2020, 12, 3)), ("05.03.2019 09:00", date(2019, 3, 5)),
        ("Сегодня, 10:15", date(2021, 6, 15)), ("вчера в 9", date(2021, 6, 14)), ("1 января 1999", None), ("31 февраля 2020", None), ("нет", None), (None, None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r["i"]: r["d"] for r in df.select("i", c.russian_date(F.col("t"), F.lit("2021-06-15").cast("date")).alias("d")).collect()}
    assert got == {i: d for i, (_, d) in enumerate(cases)}


def test_comments_and_long_words(spark):
    text = '{"edges": [{"node": {"text": "a", "created_at": 1, "id": "x", "edge_threaded_comments": {"edges": [{"node": {"text": "b", "created_at": 2, "id": "y"}}]}}}, {"node": {"text": "c", "created_at": 3, "id": "z", "edge_threaded_comments": null}}]}'
    n = "text string, created_at bigint, id string"
    schema = f"struct<edges:array<struct<node:struct<{n.replace(' ', ':').replace(',:', ',')},edge_threaded_comments:struct<edges:array<struct<node:struct<{n.replace(' ', ':').replace(',:', ',')}>>>>>>>>"
    got = spark.createDataFrame([(text,)], "j string").select(F.from_json("j", schema).alias("j")).select(F.inline(c.comments(F.col("j.edges")))).collect()
    assert [tuple(r) for r in got] == [("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")]
    assert one(spark, "<b>The OLD_man\tis here</b>", c.long_words) == "the oldman here"


def test_registry(spark, tmp_path):
    from tidemark.operators import registry

    m = artm.Model(["b", "a", "c"], np.array([[0.1, 0.9], [0.6, 0.1], [0.3, 0.0]]), [3.0, 2.5])
    at = f"file://{tmp_path}/models"
    registry.save(spark, at, "one", m, corpus="main", documents=7)
    registry.save(spark, at, "two", m, ready=False)
    got = registry.load(spark, at, "one")
    assert got.words == m.words and np.array_equal(got.phi, m.phi) and registry.find(spark, at, "one")["number_of_documents"] == 7
    registry.save(spark, at, "one", artm.Model(["z"], np.array([[1.0, 1.0, 1.0]]), []))
    assert registry.load(spark, at, "one").words == ["z"] and registry.models(spark, at).count() == 2
    for name in ("two", "three"):
        with pytest.raises(KeyError):
            registry.find(spark, at, name)


def test_upsert_and_counters(spark):
    old = spark.createDataFrame([(1, "a", 5), (None, "b", 6), (2, "c", 7)], "k int, s string, n int")
    new = spark.createDataFrame([(1, "a", 8), (None, "b", 9), (3, "c", 1)], "k int, s string, n int")
    got = relational.upsert(old, new, ["k", "s"], F.lit("now")).collect()
    assert {(r["k"], r["s"], r["n"], r["modified"]) for r in got} == {(1, "a", 8, "now"), (None, "b", 9, "now"), (2, "c", 7, None), (3, "c", 1, "now")}
    grown = relational.increased_only(old, spark.createDataFrame([(1, 4), (2, 9)], "k int, n int"), "k", "n")
    assert {(r["k"], r["n"]) for r in grown.collect()} == {(1, 5), (None, 6), (2, 9)}


def test_files_are_replaced_by_partition(spark, tmp_path):
    at = f"file://{tmp_path}/t"
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string")
    files.overwrite_partitions(frame([(1, "a"), (2, "b")]), at, "k")
    files.overwrite_partitions(frame([(2, "c")]), at, "k")
    files.append(frame([(3, "d")]).select("v", F.lit(3).alias("k")).select("k", "v").repartition(1), f"{at}2")
    files.append(frame([(4, "e")]), f"{at}2")
    assert {(r["k"], r["v"]) for r in spark.read.parquet(at).collect()} == {(1, "a"), (2, "c")} and spark.read.parquet(f"{at}2").count() == 2
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts" / "a.txt").write_text("x\ny")
    assert [r["text"] for r in files.whole_texts(spark, f"file://{tmp_path}/texts").collect()] == ["x\ny"]


def test_records_by_redirect(spark):
    pages = spark.createDataFrame([(1, "http://a/b", None), (2, "https://q", "https://a/b/"), (3, "http://none", "http://no")], "i int, url string, redirect_url string")
    records = spark.createDataFrame([("https://a/b", 77)], "url string, record_id long")
    assert {r["i"]: r["record_id"] for r in files.with_normal_url(pages, records).collect()} == {1: 77, 2: 77, 3: None}


def test_shared_folder_is_asked_for_on_a_cluster():
    from types import SimpleNamespace

    from tidemark import scratch

    jvm = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False)))
    conf = lambda: SimpleNamespace(get=lambda k: None)
    with pytest.raises(RuntimeError):
        scratch.shared_dir(SimpleNamespace(sparkContext=SimpleNamespace(master="yarn", getConf=conf, _jsc=jvm)))


def test_posts_of_networks(spark):
    day = "timestamp_ntz'2024-01-05 10:00:00'"
    wall = spark.sql(f"select 1 as account_id, -9 as owner_id, 5 as id, {day} as date, repeat('x', 151) as text, struct(2 as count) as comments, struct(3 as count) as reposts, struct(4 as count) as likes")
    r = posts.wall(wall).first()
    assert (r["url"], r["num_comments"], r["num_shares"], r["num_likes"], r["num_views"]) == ("1-5", 2, 3, 4, None)
    assert r["title"] == "Пост от 2024-01-05 10:00:00: " + "x" * 150 + "..." and posts.wall(wall, "owner_id").first()["url"] == "-9-5"
    photo = spark.sql(f"select 1 as account_id, {day} as date, cast(c as string) as caption, 3 as likes_count, 4 as comments_count, 'u' as display_url from values ('a #b #c'), (null) as t(c)")
    assert [r["hashtags"] for r in posts.photos(photo).collect()] == [["b", "c"], []]
    video = spark.sql(f"select 1 as account_id, 'v' as video_id, {day} as date, 't' as video_title, 'd' as video_description, 'a|b' as video_tags, 1 as video_comment_count, 2 as video_like_count, 3 as video_view_count")
    r = posts.videos(video).first()
    assert (r["title"], r["text"], r["url"], r["hashtags"], r["num_views"]) == ("Пост от 2024-01-05 10:00:00: t", "d", "1-v", ["a", "b"], 3)


def test_posts_inserted_and_updated(spark):
    rows = [(1, 1, "2024-01-10", "a"), (1, 2, "2024-01-10", "a"), (1, 3, "2024-01-08", "a"), (1, 4, "2024-01-08", "a"), (1, 5, "2024-01-05", "a"), (1, 6, "2024-01-10", ""),
            (1, 7, "2024-01-10", None), (2, 8, "2020-01-01", "a"), (1, 9, None, "a"), (1, None, "2024-01-10", "a"), (1, None, "2024-01-10", "a"), (1, 1, "2024-01-09", "b")]
    df = spark.createDataFrame(rows, "account_id long, id long, date string, text string").withColumn("date", F.col("date").cast("timestamp_ntz")).withColumn("views", F.lit(1))
    target = spark.createDataFrame([("1-2",), ("1-4",), (None,)], "url string")
    last = spark.sql("select 1L as account_id, timestamp_ntz'2024-01-09 00:00:00' as last")
    got = sorted((r["url"] or "", r["action"]) for r in posts.planned(posts.channel(df), target, last).collect())
    assert got == [("", "insert"), ("", "insert"), ("1-1", "insert"), ("1-3", "insert"), ("1-4", "update"), ("1-9", "insert"), ("2-8", "insert")]
    assert posts.planned(posts.channel(df.limit(0)), target, last).count() == 0


def test_coherence_of_the_topic_model(spark):
    rng = np.random.default_rng(5)
    counts, cells = rng.random((7, 3)), [(0, 1, 2.0), (1, 4, 0.5), (6, 0, 1.0), (3, 3, 4.0)]
    want = np.zeros_like(counts)
    for i, j, v in cells:
        want[i] += v * counts[j]
        if i != j:
            want[j] += v * counts[i]
    assert np.allclose(artm.neighbours(spark.createDataFrame(cells, "at1 int, at2 int, value double").repartition(3), counts), want)
    bow = spark.createDataFrame([(d, f"w{(d % 2) * 4 + k}", 1 + k) for d in range(20) for k in range(4)], "doc_id long, word string, tf long")
    pairs = spark.createDataFrame([("w0", "w1", 1.0), ("w0", "other", 9.0)], "w1 string, w2 string, value double")
    plain, favoured = (artm.fit(bow, artm.Settings(topics=2, passes=3, coherence=c), pairs=pairs) for c in (0.0, 5.0))
    share = lambda m: m.phi[[m.words.index(w) for w in ("w0", "w1")]].max(axis=1).sum()
    assert np.allclose(favoured.phi.sum(axis=0), 1) and share(favoured) > share(plain)


def test_mapping_of_windows_equals_dense_formula(spark):
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(9)]
    side = lambda n: [(f"t{t}", w, float(rng.random() + 0.1)) for t in range(n) for w in rng.choice(words, 5, replace=False)]
    one, two = side(3) + [("t9", "alone", 1.0)], side(4)
    dist = {(a, b): float(rng.choice([0.0, 0.01, 0.3, 0.7, 1.0])) for i, a in enumerate(words) for b in words[i + 1 :]}
    alike = lambda a, b: 1.0 if a == b else 1 - dist.get((a, b), dist.get((b, a), 1.0))
    w1, w2 = (spark.createDataFrame(x, "topic_id string, word string, w double") for x in (one, two))
    cells = similarity.word_cells(w1, w2, clusters.both_ways(spark.createDataFrame([(*k, v) for k, v in dist.items()], "a string, b string, distance double")))
    got = {(r["t1"], r["t2"]): r["score"] for r in similarity.semantic_mapping(cells, w1, w2).collect()}
    mutual = {(r["t1"], r["t2"]): r["score"] for r in similarity.mutual_similarity(cells, w1, w2, 0.5).collect()}
    for t1 in {t for t, _, _ in one}:
        for t2 in {t for t, _, _ in two}:
            rows, cols = (sorted((w, v) for t, w, v in x if t == y) for x, y in ((one, t1), (two, t2)))
            s = np.round(np.array([[alike(a, b) for b, _ in cols] for a, _ in rows]), 12)
            weight = np.outer([v for _, v in rows], [v for _, v in cols])
            whole = 0.0
            for m, x in ((s, weight), (s.T, weight.T)):
                best = m.max(axis=1)
                limit = np.round(best.mean() - best.std(), 12)
                whole += sum(x[i, m[i].argmax()] * best[i] for i in range(len(best)) if best[i] > limit)
            true = (weight * (s - 0.8))[s >= 0.97].sum()
            assert abs(got.pop((t1, t2)) - (true / whole if whole > 0 else 0.0)) < 1e-9
            total = (weight * s).sum()
            assert abs(mutual.pop((t1, t2)) - ((weight * s)[s >= 0.5].sum() / total if total > 0 else 0.0)) < 1e-9
    assert not got and not mutual


def test_texts_are_dealt_by_their_length(spark, monkeypatch):
    """More text makes more parts, so that a task's table of words stays as large; the counts stay the same."""
    rows = [(i % 40, "one two three two " * (1 + i % 7)) for i in range(100)] + [(1, None), (None, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = lambda: sorted(map(tuple, dictionary.word_counts(docs, 2).collect()))
    before = counts()
    monkeypatch.setattr(dictionary, "TASK_CHARS", 100)
    chars = sum(len(t or "") for _, t in rows)
    assert dictionary.dealt(docs, "doc_id", "text").rdd.getNumPartitions() == -(-chars // 100)
    assert dictionary.dealt(docs.limit(0), "doc_id", "text").count() == 0
    assert counts() == before


def test_cleaned_words_of_every_character(spark):
    """The same as replacing ``NOT_WORD``, for all characters of the basic plane, some beyond, and runs with stars."""
    import re

    rng = random.Random(5)
    every = [chr(i) for i in [*range(1, 0xD800), *range(0xE000, 0x10000), 0x1F600, 0x10400] if chr(i).lower() == chr(i) or chr(i).isascii() or re.match(f"[{c.RUSSIAN}{c.KAZAKH}]", chr(i))]
    texts = ["".join(f"a{x}b" for x in every[i : i + 500]) for i in range(0, len(every), 500)] + [None, "", " ", "-"]
    texts += ["".join(rng.choice("aБқß $*-\u2028\U0001f600") for _ in range(60)) for _ in range(300)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(c.cleaned_words(F.col("t"))).collect()
    for t, (w,) in zip(texts, got, strict=True):
        assert w == (None if t is None else [x for x in re.sub(c.NOT_WORD, " ", t).lower().split(" ") if x])


def test_e_step_of_many_documents():
    """The same as one document at a time; rows of one place add up."""
    rng, s = np.random.default_rng(2), artm.Settings(topics=3, smooth_theta=-0.05)
    phi, first = rng.random((20, 3)), np.array([0, 1, 5, 12])
    at, tf = rng.integers(0, 20, 30), rng.integers(1, 5, 30).astype(float)
    theta, counts, log = artm.e_steps(phi, at, tf, first, s)
    total, want = np.zeros_like(phi), np.zeros_like(phi)
    for k, (i, j) in enumerate(zip(first, [*first[1:], 30], strict=True)):
        one = artm.e_step(phi, at[i:j], tf[i:j], s)
        assert np.allclose(theta[k], one[0]) and np.allclose(counts[i:j], one[1]) and np.isclose(log[k], one[2])
        np.add.at(want, at[i:j], one[1])
    artm.add_rows(total, at, counts)
    assert np.allclose(total, want)
    assert [len(x) for x in artm.e_steps(phi, at[:0], tf[:0], first[:0], s)] == [0, 0, 0]


def test_clot_queries_make_distances_once(spark, monkeypatch):
    from tidemark.plans import similarity as plans

    made, plain = [], plans._distances
    monkeypatch.setattr(plans, "_distances", lambda *a: made.append(1) or plain(*a))
    for name in ("clot_weights", "clot_key_objects"):
        plans.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(made) == 2


def test_passes_have_no_more_tasks_than_cores(spark, monkeypatch):
    """Each task of a pass sends counts of all its words; documents in many parts make no more of them."""
    from tidemark.operators import artm as module

    rows = [(d, f"w{(d * 7 + k) % 30}", 1 + k % 3) for d in range(60) for k in range(5)]
    bow = spark.createDataFrame(rows, "doc_id long, word string, tf long")
    seen, plain, bags = [], module._dense, module._bags
    monkeypatch.setattr(module, "_dense", lambda cells, shape: seen.append(cells.rdd.getNumPartitions()) or plain(cells, shape))
    monkeypatch.setattr(module, "_bags", lambda *a: bags(*a).repartition(37))
    model = module.fit(bow, module.Settings(topics=3, passes=2))
    assert max(seen) <= spark.sparkContext.defaultParallelism and np.allclose(model.phi.sum(axis=0), 1)


def test_wordpiece_splits_a_run_once(spark, monkeypatch):
    """Runs between blanks are remembered; results as for whole texts, with every kind of space, signs and controls."""
    rng = random.Random(8)
    texts = ["".join(rng.choice("abÉß ,\t\n\x0b\u2028\u00a0\u3000\x85漢.Σ") for _ in range(80)) for _ in range(50)] + ["", None, "a" * 500, "x " * 50]
    vocab = ["a", "b", "##a", "##b", "e", "##e", ",", ".", "漢", "##ß", "x"]
    got = wordpiece.tokenize(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), vocab)
    want = {i: [p for w in wordpiece.basic(t or "") for p in wordpiece.pieces(w, frozenset(vocab))] for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["tokens"] for r in got.collect()} == want
    assert wordpiece.MOST_KEPT == 200


def _shuffled(spark) -> int:
    """Bytes that all stages so far have written for shuffles."""
    sc = spark.sparkContext
    none = sc._jvm.java.util.ArrayList()
    stages = sc._jsc.sc().statusStore().stageList(none, False, False, sc._gateway.new_array(sc._jvm.double, 0), none)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_blocks_stand_in_small_row_groups(spark):
    """A reader holds a row group: two blocks, not the hundred that Parquet waits for unasked."""
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.expr("repeat(concat('word', id, ' '), 2000)").alias("text")).coalesce(1)
    blocks = frequent._blocks(docs, "doc_id", 50_000)
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{blocks.scratch.removeprefix('file://')}/*.parquet")]
    assert blocks.count() > 40 and max(m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)) <= 4


def test_ngramize_shuffles_hashes_not_ngrams(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(path)
    before = _shuffled(spark)
    assert frequent.ngramize_frequent(docs).count() == docs.count()
    assert _shuffled(spark) - before < 4 * os.path.getsize(path)


@pytest.mark.parametrize("bits", [40, 9])
def test_ngramize_frequent(spark, bits):
    """Blocks of a few documents; with 9 bits most n-grams share their hash with others."""
    texts = [" ".join(f"{'ab'[i * j % 2]}{'жyz'[(i + j * j) % 3]}{'q' * (i * 7 % (j % 5 + 1))}" for j in range(i % 40)) for i in range(60)]
    docs = spark.createDataFrame([*enumerate([*texts, None, "", "One!", "a-b a-b a-b"])], "doc_id long, text string").repartition(3)
    for glue in (True, False):
        got = frequent.ngramize_frequent(docs, 3, 5, glue, block_bytes=700, shard_bytes=500, bits=bits).collect()
        want = frequent._by_words(docs, 3, 5, glue, "doc_id", "text").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    twice = docs.unionAll(docs.limit(3))
    assert sorted(map(str, frequent.ngramize_frequent(twice).collect())) == sorted(map(str, frequent._by_words(twice, 3, 5, True, "doc_id", "text").collect()))
    assert frequent.ngramize_frequent(docs.limit(0)).count() == 0


def test_totals_of_topics_shuffle_no_words(spark):
    """A few topics would take all words in as many tasks."""
    from tidemark.plans import views

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        words = spark.createDataFrame([(1, "topic_1", "a", 2), (1, "topic_2", "b", 1)], "doc_id long, topic_id string, word string, tf long")
        phi = views.phi(spark, "", words)
        assert "SortMergeJoin" not in phi._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [topic_id" not in topics.tfidf(phi.select("topic_id", "word", "tf"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _sorted_rows(df) -> list[int]:
    """Rows that each sort of the plan that ran was given."""
    df.collect()
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        below = [node.children().apply(i) for i in range(node.children().size())]
        todo += below
        if node.nodeName() == "Sort":
            at = below[0]
            while not at.metrics().contains("numOutputRows"):
                at = at.children().apply(0)
            out.append(at.metrics().apply("numOutputRows").value())
    return out


def test_ranked_sorts_only_what_can_rank(spark):
    rng = random.Random(5)
    rows = [(f"topic_{i % 3}", f"w{i}", rng.choice([0.0, 1e-5, 0.25, 1 / rng.randint(1, 5000), rng.random()])) for i in range(6000)] + [(None, "x", 0.5), ("topic_9", "y", math.inf)]
    phi = spark.createDataFrame(rows, "topic_id string, word string, weight double")
    for least, most in ((0.0, 25), (1e-4, 100), (0.9, 3), (-1.0, 5000)):
        want = []
        for t in ("topic_0", "topic_1", "topic_2", "topic_9", None):
            own = sorted((r for r in rows if r[0] == t and r[2] > least), key=lambda r: (-r[2], r[1]))
            want += [(*r, i) for i, r in enumerate(own[:most], 1)]
        assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in topics.ranked(phi, least, most).collect())
    nan = spark.createDataFrame([("t", "a", 2.0), ("t", "b", math.nan), ("t", "c", 1.0)], phi.schema)
    assert [r["word"] for r in topics.ranked(nan, 0.0, 1).collect()] == ["b"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert max(_sorted_rows(topics.ranked(phi, 0.0, 25))) < 1000  # each topic's step of the 25th word takes many alike
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_kernel_deals_words_by_rows(spark, monkeypatch):
    """Parts of a fixed size, and no more than a row's words of all topics in one."""
    monkeypatch.setattr(dictionary, "TASK_ROWS", 50)
    rows = [(f"topic_{i % 4}", f"w{i % 97}", 1 + i % 7) for i in range(388)]
    phi = spark.createDataFrame(rows, "topic_id string, word string, weight long")
    total, want = {}, {}
    for _, w, x in rows:
        total[w] = total.get(w, 0) + x
    for t, w, x in rows:
        if x / total[w] > 0.3:
            n, m, c = want.get(t, (0, 0, 0.0))
            want[t] = (n + 1, m + x, c + x / total[w])
    found = topics.kernel(phi)
    assert {r["topic_id"]: (r["kernel_size"], r["purity"], round(r["contrast"] * r["kernel_size"], 9)) for r in found.collect()} == {t: (n, m, round(c, 9)) for t, (n, m, c) in want.items()}
    assert "hashpartitioning(word#" in (plan := found._jdf.queryExecution().executedPlan().toString()) and ", 8), REPARTITION_BY_NUM" in plan


def test_tfidf_deals_words_by_rows(spark, monkeypatch):
    monkeypatch.setattr(dictionary, "TASK_ROWS", 50)
    rows = [(f"topic_{i % 4}", f"w{i % 97}" if i % 3 else f"v{i}", 1 + i % 7) for i in range(388)]
    found = topics.tfidf(spark.createDataFrame([*rows, ("topic_1", None, 3)], "topic_id string, word string, tf long"))
    df = Counter(w for _, w, _ in rows)
    raw = {(t, w): f * (math.log(5 / (1 + df[w])) + 1) for t, w, f in rows}
    top = {t: max(x for (s, _), x in raw.items() if s == t) for t, _, _ in rows}
    assert {(r["topic_id"], r["word"]): round(r["relative"], 9) for r in found.collect()} == {(t, w): round(x / top[t], 9) for (t, w), x in raw.items()}
    assert ", 8), REPARTITION_BY_NUM" in (plan := found._jdf.queryExecution().executedPlan().toString()) and "SortMergeJoin" not in plan


def test_theta_deals_items_by_rows(spark, monkeypatch, tmp_path):
    """Parts of a fixed size, in which a document's items are added up, weighed and met: they are shuffled once."""
    from tidemark.plans import views

    monkeypatch.setattr(dictionary, "TASK_ROWS", 50)
    items = [(i % 90, i * 7 % 40, float(1 + i % 5)) for i in range(400)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    theta = views.theta(spark, str(tmp_path))
    q, total = {}, {}
    for o, p, n in items:
        q[o, f"topic_{p % 20}"] = q.get((o, f"topic_{p % 20}"), 0) + n
        total[o] = total.get(o, 0) + n
    assert {(r["document_id"], r["topic_id"]): r["topic_weight"] for r in theta.collect()} == {k: n / total[k[0]] for k, n in q.items()}
    assert theta.rdd.getNumPartitions() == 8
    assert theta._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange") == 1
