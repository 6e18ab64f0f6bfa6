"""Cosine join, density grids, quantiles and the sharded topic model against plain re-statements."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import artm, clusters, cosine, quantiles, registry, sharded


def sparse(seed, rows, cols, cells, negative=False):
    rng = random.Random(seed)
    out = {}
    for _ in range(cells):
        v = rng.choice([1.0, 2.0, 0.5, 3.0]) * (rng.choice([-1, 1]) if negative else 1)
        out[f"r{rng.randrange(rows)}", min(cols - 1, int(rng.expovariate(0.15)))] = v
    return out


def cosines(cells):
    vec = {}
    for (r, c), v in cells.items():
        vec.setdefault(r, {})[c] = v
    unit = {r: {c: v / math.sqrt(sum(x * x for x in d.values())) for c, v in d.items()} for r, d in vec.items()}
    return {(a, b): sum(v * unit[b].get(c, 0.0) for c, v in unit[a].items()) for a, b in itertools.combinations(sorted(unit), 2)}


@pytest.mark.parametrize("seed,negative,threshold", [(1, False, 0.7), (2, True, 0.5), (3, False, 0.95), (4, False, 0.2)])
def test_similar_pairs(spark, seed, negative, threshold):
    cells = sparse(seed, 60, 40, 500, negative)
    rows = [(r, c, v) for (r, c), v in cells.items()] + [("none", 1, 0.0), (None, 1, 1.0), ("r1", None, 2.0), ("r2", 5, None)]
    df = spark.createDataFrame(rows, "row string, col int, v double").withColumn("at", F.lit(1))
    got = {(r["a"], r["b"]): r["similarity"] for r in cosine.similar_pairs(df.select("row", "col", "v"), threshold).collect()}
    want = {k: v for k, v in cosines(cells).items() if v >= threshold}
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_prefixes_leave_most_pairs_out(spark):
    """Rows that share only a column everybody has are no candidates."""
    rows = [(i, 0, 1.0) for i in range(200)] + [(i, 1 + i // 2, 2.0) for i in range(200)]
    df = spark.createDataFrame(rows, "row long, col int, v double")
    assert cosine.candidates(df, 0.9).count() == 100
    assert {(r["a"], r["b"]) for r in cosine.similar_pairs(df, 0.9).collect()} == {(i, i + 1) for i in range(0, 200, 2)}
    assert cosine.similar_pairs(df.limit(0), 0.9).count() == 0


def grid_labels(dist, points, eps, least):
    near = {p: [q for q in points if q != p and dist.get((min(p, q), max(p, q)), 2) <= eps] for p in points}
    core = [p for p in points if len(near[p]) + 1 >= least]
    label, n = {}, 0
    for p in core:
        if p not in label:
            todo = [p]
            while todo:
                x = todo.pop()
                if x not in label:
                    label[x] = n
                    todo += [q for q in near[x] if q in set(core)]
            n += 1
    return {p: label.get(p, min((label[q] for q in near[p] if q in label), default=-1)) for p in points}


@pytest.mark.parametrize("most", [10**6, 0])
def test_dbscan_grid(spark, monkeypatch, most):
    monkeypatch.setattr(clusters, "MOST_FOREST", most)
    rng = random.Random(7)
    at = {p: (rng.random(), rng.random()) for p in range(40)}
    dist = {(p, q): math.dist(at[p], at[q]) for p, q in itertools.combinations(at, 2)}
    grid = [(e / 20, n) for e in (1, 2, 4) for n in (1, 3, 5)] + [(2.0, 3), (2.0, 100)]
    pairs = spark.createDataFrame([(a, b, v) for (a, b), v in dist.items() if v <= 0.2], "a long, b long, distance double").repartition(5)
    points = spark.createDataFrame([(p,) for p in at], "point long")
    got = {(r["cell"], r["point"]): r["label"] for r in clusters.dbscan_grid(pairs, points, grid, unlisted=2.0).collect()}
    assert got == {(i, p): y for i, (e, n) in enumerate(grid) for p, y in grid_labels(dist, sorted(at), e, n).items()}


@pytest.mark.parametrize("left", [4096, 3])
def test_quantiles(spark, monkeypatch, left):
    monkeypatch.setattr(quantiles, "LEFT", left)
    monkeypatch.setattr(quantiles, "ACCURACY", 10)
    rng = np.random.default_rng(3)
    shares = [0, 0.1, 1 / 3, 0.5, 0.97, 1]
    for values in ([], [2.5], rng.normal(size=3000).tolist(), [1.0] * 900 + rng.normal(size=300).tolist(), (10.0 ** rng.uniform(-300, 300, 500)).tolist() + [0.0, -0.0, -7.0]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(4)
        got, want = quantiles.quantiles(df, "v", shares), [None] * 6 if not values else [float(x) for x in np.quantile(values, shares)]
        assert all(a == b or abs(a - b) <= 1e-12 * abs(b) for a, b in zip(got, want))
    df = spark.createDataFrame([(math.nan,), (-math.inf,), (2.0,)], "v double")
    assert quantiles.quantiles(df, "v", [0, 0.5]) == [-math.inf, 2.0] and math.isnan(quantiles.quantiles(df, "v", [1])[0])
    plan = df.select(F.percentile_approx("v", F.array(F.lit(0.1)), F.lit(10)))._jdf.queryExecution().toString()
    assert "partial_percentile_approx" in plan  # sketches combine in their tasks


def bags(seed, docs=40, words=30):
    rng = random.Random(seed)
    rows = {}
    for d in range(docs):
        for _ in range(rng.randint(3, 25)):
            w = f"w{(d % 3) * 10 + min(9, int(rng.expovariate(0.4)))}" if rng.random() < 0.8 else f"w{rng.randrange(words)}"
            rows[d, w] = rows.get((d, w), 0) + 1
    return [(d, w, n) for (d, w), n in rows.items()]


@pytest.mark.parametrize("many", [10**6, 0])
def test_sharded_model_is_the_dense_one(spark, monkeypatch, tmp_path, many):
    monkeypatch.setattr(sharded, "BLOCK_ENTRIES", 60)
    monkeypatch.setattr(sharded, "MANY_BLOCKS", many)
    rows = bags(5)
    bow = spark.createDataFrame(rows, "doc_id long, word string, tf int").withColumn("at", F.lit("x")).repartition(3)
    pairs = spark.createDataFrame([("w1", "w2", 2.0), ("w11", "w12", 1.0), ("w3", "w3", 1.0), ("w1", "unknown", 9.0)], "w1 string, w2 string, value double")
    s = artm.Settings(topics=3, passes=3, smooth_phi=0.01, smooth_theta=0.02, decorrelate=0.05, coherence=0.1)
    bow = bow.select("doc_id", "word", "tf")
    dense, table = artm.fit(bow, s, 25, pairs), sharded.fit(bow, s, 25, pairs)
    got = {r["word"]: (r["place"], r["weights"]) for r in table.rows().collect()}
    assert sorted(got) == sorted(dense.words)
    assert all(got[w][0] == i and np.allclose(got[w][1], dense.phi[i], atol=1e-5) for i, w in enumerate(dense.words))
    assert np.allclose(table.perplexity, dense.perplexity, rtol=1e-5)
    theta = lambda df: {(r["document_id"], r["topic_id"]): r["topic_weight"] for r in df.collect()}
    one, two = theta(artm.transform(bow, dense, s, 0.01)), theta(sharded.transform(bow, table, s, 0.01))
    assert all(abs(one.get(k, 0.01) - two.get(k, 0.01)) < 1e-3 for k in one.keys() | two.keys())
    if many:
        registry.save_sharded(spark, str(tmp_path), "big", table, documents=40)
        again = registry.load_sharded(spark, str(tmp_path), "big")
        three = theta(sharded.transform(bow, again, s, 0.01))
        assert two.keys() == three.keys() and all(abs(two[k] - three[k]) < 1e-5 for k in two)
        assert np.allclose(registry.load(spark, str(tmp_path), "big").phi, dense.phi, atol=1e-5)
        assert table.phi(0.5).count() == int((dense.phi >= 0.5).sum())


def test_sharded_model_without_documents(spark):
    bow = spark.createDataFrame([(None, "a", 1), (1, None, 2), (1, "b", None)], "doc_id long, word string, tf int")
    model = sharded.fit(bow, artm.Settings(topics=2, passes=1))
    assert model.rows().count() <= 1 and sharded.transform(bow, model, artm.Settings(topics=2)).count() == 0


@pytest.mark.parametrize("most", [500_000, 3])
def test_phrases(spark, monkeypatch, most):
    from collections import Counter

    from tidemark.operators import geo

    monkeypatch.setattr(geo, "MOST_NAMES", most)
    rng = random.Random(8)
    names = [" ".join(rng.choice("abc") * 3 for _ in range(rng.randint(1, 8))) for _ in range(25)] + ["Aaa  bbb!", "", None, "???", "aaa"]
    docs = [(i, " ".join(rng.choice(["aaa", "bbb", "ccc", "zzz"]) for _ in range(rng.randint(0, 40))), rng.choice([None, "aaa bbb", "BBB, ccc"])) for i in range(40)] + [(3, "aaa aaa", None), (None, "aaa", "")]
    gaz = spark.createDataFrame([(i, "x", n) for i, n in enumerate(names)], "id int, level string, name string")
    got = {(r["doc_id"], r["location_id"]): r["tf"] for r in geo.phrase_hits(spark.createDataFrame(docs, "doc_id long, text string, title string").repartition(3), gaz, ["text", "title"]).collect()}
    want = Counter()
    clean = lambda t: "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
    for d, *fields in docs:
        for w in map(clean, fields):
            for i, n in enumerate(map(clean, names)):
                want[d, i] += sum(bool(n) and w[k : k + len(n)] == n for k in range(len(w)))
    assert got == {k: n for k, n in want.items() if n}
    assert geo.phrase_hits(spark.createDataFrame([], "doc_id long, text string"), gaz, ["text"]).count() == 0
    assert geo.phrase_hits(spark.createDataFrame([(1, "a")], "doc_id long, text string"), gaz.limit(0), ["text"]).count() == 0


def test_mapping_words_and_dates(spark):
    from datetime import datetime

    from tidemark.operators import similarity

    one = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "z"), ("b", "x")], "topic_id string, word string")
    two = spark.createDataFrame([("p", "x"), ("p", "q"), ("r", "x"), ("r", "y"), ("r", "z")], "topic_id string, word string")
    mapped = spark.createDataFrame([(0.3, "a", "p"), (0.3, "a", "r"), (0.4, "a", "p"), (0.3, "b", "none")], "threshold double, t1 string, t2 string")
    got = sorted(tuple(r) for r in similarity.delta_words(mapped, one, two).collect())
    assert got == [(0.3, "a", "p", ["y", "z"], 2), (0.3, "a", "r", [], 0), (0.3, "b", "none", ["x"], 1), (0.4, "a", "p", ["y", "z"], 2)]
    day = lambda n: datetime(2020, 1, n)
    schema = "document_id long, topic_id string, topic_weight double, datetime timestamp_ntz"
    first = spark.createDataFrame([(1, "a", 0.5, day(1)), (2, "a", 0.5, day(5)), (3, "a", 0.5, day(6)), (4, "a", 0.01, day(5)), (9, "a", 0.5, None)], schema)
    second = spark.createDataFrame([(1, "p", 0.5, day(1)), (2, "p", 0.05, day(5)), (4, "p", 0.5, day(5)), (3, "r", 0.5, day(6)), (2, "r", 0.9, day(5)), (5, "r", 0.9, day(9))], schema)
    run = lambda dates: {r["threshold"]: tuple(r)[1:] for r in similarity.validate_mapping(mapped.where("t1 = 'a'"), first, second, 4, [0.3, 0.4, 0.5], dates).collect()}
    # in days 5 to 6: a {2, 3}, p {2, 4}, r {2, 3}
    inside, every = run((day(5), day(6))), run(None)
    assert inside[0.3] == (0.25, pytest.approx((1 / 3 + 1) / 2, abs=1e-6), 1.0) and inside[0.4][1:] == (pytest.approx(1 / 3, abs=1e-6), 0.0)
    assert inside[0.5] == (0.0, 0.0, None)  # nothing is mapped: no scaled score
    assert every[0.4][1] == pytest.approx(2 / 5, abs=1e-6)  # a {1, 2, 3, 9}, p {1, 2, 4}


def test_topic_weights_are_by_rarity(spark):
    """A list's word weighs by in how few lists it stands, not by its frequency."""
    from tidemark.operators import topics

    lists = spark.createDataFrame([("a", "both", 1), ("a", "own", 1), ("b", "both", 1)], "topic_id string, word string, tf int")
    got = {(r["topic_id"], r["word"]): r["relative"] for r in topics.tfidf(lists).collect()}
    assert got["a", "own"] == 1.0 and got["b", "both"] == 1.0 and got["a", "both"] == pytest.approx(1 / (math.log(1.5) + 1))


def all_clots(dist, names, d1, d2, medoid):
    """Whole clots by plain loops over the full matrix."""
    at = lambda a, b: 0.0 if a == b else dist.get((min(a, b), max(a, b)), 1.0)
    out = {}
    for seed in names:
        hood = [x for x in names if at(seed, x) <= d2]
        start = min(hood, key=lambda x: sum(at(y, x) for y in hood)) if medoid else seed
        inside, rest = [start], [x for x in hood if x != start]
        while True:
            rest = [x for x in rest if all(at(x, y) <= d1 for y in inside)]
            if not rest:
                break
            best = min(rest, key=lambda x: sum(at(x, y) for y in inside))
            inside.append(best)
            rest.remove(best)
        out[seed] = sorted(inside)
    return out


@pytest.mark.parametrize("seed,d1,d2,medoid,cells", [(1, 0.3, 0.4, True, 10**6), (2, 0.3, 0.4, False, 50), (3, 0.5, 0.25, True, 50), (4, 0.25, 0.99, True, 500), (5, 1.0, 0.5, False, 1)])
def test_whole_clots(spark, monkeypatch, seed, d1, d2, medoid, cells):
    monkeypatch.setattr(clusters, "CLOT_CELLS", cells)
    rng = random.Random(seed)
    names = [f"w{i:02d}" if i % 5 else f"ё {i:02d}" for i in range(30)]
    # quarters are exact in binary, so that ties are ties however they are summed
    dist = {(a, b): rng.choice([0.125, 0.25, 0.25, 0.5, 0.75, 1.0]) for a, b in itertools.combinations(sorted(names), 2) if rng.random() < 0.7}
    rows = [(a, b, v) for (a, b), v in dist.items()] + [(None, "w01", 0.1), ("w01", None, 0.1), ("w01", "w02x", None)]
    df = spark.createDataFrame(rows, "a string, b string, distance double").repartition(5).withColumn("seed", F.lit("clash"))
    got = {r["seed"]: list(r["members"]) for r in clusters.clots(df, d1, d2, medoid).collect()}
    assert got == all_clots(dist, sorted(names), d1, d2, medoid)
    assert clusters.clots(df.limit(0), d1, d2, medoid).count() == 0
    with pytest.raises(ValueError, match="under 1"):
        clusters.clots(df, d1, 1.0)
