"""Operators 11 to 13 against brute force, on small awkward tables."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence, language, negatives, topk, url_filter, vectors

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


# 11 -------------------------------------------------------------------------------------------------------------------
def audit(rows, most_terms=200):
    """lang, source, part, item, value, rank from (lang, source, text) rows."""
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    df, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        words = [lower(w) for w in TERM.findall(text)]
        df[lang].update(set(words))
        count[lang, source].update(words)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= 3]

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        every = shares(sum((count[lang, s] for s in sources), Counter()))
        p = {s: shares(count[lang, s]) for s in sources}
        f = lambda a, b: (a - b) * (a - b) // b
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], every[t])) for t in kept if count[lang, s][t] and p[s][t] > every[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(found, 1) if part == "pair" or r <= most_terms]
    return sorted(out)


def corpus(seed, sources, docs, words):
    rng = random.Random(seed)
    vocab = [rng.choice(["Aé", "b", "Cc", "дом", "z_z", "x9y", "K"]) + chr(97 + i % 26) * (i // 26 + 1) for i in range(words)]
    rows = []
    for _ in range(docs):
        text = " ".join(vocab[min(words - 1, int(rng.expovariate(0.05)))] for _ in range(rng.randint(0, 30)))
        rows.append((rng.choice(["en", "de"]), f"s{min(sources - 1, int(rng.expovariate(0.2)))}", text))
    return rows


AWKWARD = [
    (None, None, None), ("", "", "a a a"), (None, "x", "a"), ("fr", "only", "b c d"), ("en", None, "!!! 123"), ("en", "s0", None),
    ("en", "long", "ant Bee " * 20_000), ("en", "s1", "same words here"), ("en", "s1", "same words here"), ("en", "s1", "same words here"), ("xx", "p", "q"), ("xx", "r", "q"),
]


@pytest.mark.parametrize("sources,docs,words,light", [(12, 400, 90, 8), (12, 400, 90, 1), (5, 60, 30, 8)])
def test_divergence(spark, monkeypatch, sources, docs, words, light):
    monkeypatch.setattr(divergence, "LIGHT", light)
    monkeypatch.setattr(divergence, "ENTRIES", 100)
    rows = corpus(sources, sources, docs, words) + AWKWARD
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("term", F.lit(1)).withColumn("n", F.lit("x")).repartition(4)
    assert sorted(tuple(r) for r in divergence.audit(df).collect()) == audit(rows)


def test_divergence_of_more_groups_than_a_block(spark):
    rng = random.Random(4)
    rows = [("en", f"s{i}", " ".join(rng.choice("abcdefgh") for _ in range(6))) for i in range(divergence.BLOCK + 30)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(tuple(r) for r in divergence.audit(df).collect()) == audit(rows)


def test_divergence_without_rows_or_terms(spark):
    schema = "lang string, source string, text string"
    assert divergence.audit(spark.createDataFrame([], schema)).collect() == []
    rows = [("a", "x", "once"), ("a", "y", ""), ("b", "x", None)]
    assert sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, schema)).collect()) == audit(rows)


def test_terms_end_with_their_text():
    data, offs = np.frombuffer("abÀ1Cd".encode() + b"" + b"ef g" + b"h", np.uint8), np.array([0, 7, 7, 11, 12])
    terms, doc = divergence.terms_of(data, offs)
    assert terms.to_pylist() == ["abÀ", "cd", "ef", "g", "h"] and doc.tolist() == [0, 0, 2, 2, 3]


def test_dense_terms_over_batches(monkeypatch):
    """A term whose entries are cut by a batch counts once."""
    monkeypatch.setattr(divergence, "TILE", 3)
    rng = np.random.default_rng(2)
    p0 = np.arange(5) + 10
    rows = [("l", 0, 0, b, None, g, int(p0[g])) for b in range(2) for g in range(5)]
    p = {}
    for b in range(2):
        for t in range(9):
            for g in rng.choice(5, 3, replace=False):
                p[b, t, int(g)] = int(rng.integers(20, 99))
                rows.append(("l", 0, 0, b, f"t{t}", int(g), p[b, t, int(g)]))
    rows.sort(key=lambda r: (r[3], r[4] or "", r[5]))
    types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64()]
    names = ["lang", "lo", "hi", "bucket", "term", "gi", "p"]
    whole = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    for size in (1, 2, 7, 100):
        got = Counter()
        for out in divergence._dense(iter([whole.slice(i, size) for i in range(0, len(rows), size)])):
            for r in out.to_pylist():
                got[r["a"], r["b"]] += r["value"]
        f = lambda x, y: (x - y) ** 2 // y
        want = {(a, b): sum(f(p.get((k, t, a), p0[a]), p.get((k, t, b), p0[b])) - f(p0[a], p0[b]) for k in range(2) for t in range(9)) for a in range(5) for b in range(5) if a != b}
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


# 12, 13 ---------------------------------------------------------------------------------------------------------------
def whole(vec):
    return [math.floor(256 * x) for x in vec]


def good(rows):
    return [(i, whole(v), y) for i, v, y in rows if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]


def dot(x, y):
    s = sum(a * b for a, b in zip(x, y))  # the shorter is zero-padded
    return max(vectors.NONE + 1, min(2**63 - 1, s))


def brute_search(rows, every, k):
    rows, out = good([(i, v, 0) for i, v, _ in rows]), []
    for n, (q, x, _) in enumerate(rows):
        if q % every == 0:
            found = sorted((-dot(x, y), i) for m, (i, y, _) in enumerate(rows) if m != n)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(found, 1)]
    return sorted(out)


def brute_mine(rows, every, positive=5, negative=10):
    rows, out = good(rows), []
    for n, (q, x, label) in enumerate(rows):
        if q % every:
            continue
        found = sorted((-dot(x, y), i, m) for m, (i, y, z) in enumerate(rows) if m != n and z == label)[:positive]
        for ps, pos, _ in found:
            left = sorted((-dot(x, y), i) for i, y, z in rows if z != label and 30 * -ps <= 100 * dot(x, y) <= 90 * -ps)[:negative]
            out += [(q, pos, r, i, -ps, -s) for r, (s, i) in enumerate(left, 1)]
    return sorted(out)


def cloud(seed, n, width=5, labels=4, clusters=6, spread=0.3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(clusters, width))
    of = rng.integers(0, clusters, n)
    return [(i, [float(np.float32(x)) for x in middles[of[i]] + spread * rng.normal(size=width)], int((of[i] + rng.integers(0, 2)) % labels)) for i in range(n)]


def awkward_vectors():
    rows = cloud(1, 300)
    same = rows[7][1]
    rows += [(1000 + i, same, 1) for i in range(120)]  # a hot vector, all ties
    rows += [(20, same, 2), (20, same, 2), (40, [0.5], 1), (60, [], 1), (80, [0.0] * 5, 2), (100, [-0.0, 1e-9, -1e-9, 2.0, 1.0], 3), (120, [1.0] * 9, 0)]
    rows += [(2000, None, 1), (2020, [1.0, None], 1), (2040, [1.0, float("nan")], 2), (2060, [float("inf")], 2), (2080, [1.0, 2.0], None), (None, same, 1)]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.withColumn("row", F.lit("x")).withColumn("block", F.lit(0)).withColumn("mat", F.lit(0)).withColumn("cell", F.lit(1)).repartition(5)


@pytest.mark.parametrize("block", [16, 1024])
def test_search(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES_EACH", 4)
    rows = awkward_vectors()
    got = topk.search(frame(spark, rows), F.col("vec_id") % 20 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute_search(rows, 20, 5)


@pytest.mark.parametrize("block", [16, 1024])
def test_mine(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", block // 2)
    monkeypatch.setattr(negatives, "ANCHORS_EACH", 4)
    monkeypatch.setattr(negatives, "CANDIDATES_EACH", 30)
    rows = awkward_vectors()
    got = negatives.mine(frame(spark, rows), F.col("vec_id") % 20 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute_mine(rows, 20)


def test_rings_and_nodes_prune(spark, monkeypatch):
    """On clustered vectors most pairs of blocks are never made, and the result is whole."""
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES_EACH", 2)
    monkeypatch.setattr(negatives, "ANCHORS_EACH", 4)
    monkeypatch.setattr(negatives, "CANDIDATES_EACH", 30)
    met, made = vectors.met, []

    def counted(pairs, asking, held, *more):
        made.append((pairs.count(), asking.count() * held.count()))
        return met(pairs, asking, held, *more)

    monkeypatch.setattr(vectors, "met", counted)
    rows = [(i, [10 * x / sum(y * y for y in v) ** 0.5 for x in v], y) for i, v, y in cloud(3, 600, width=8, clusters=12, spread=0.02)]
    rows = [(i, [float(np.float32(x)) for x in v], y) for i, v, y in rows]
    assert sorted(tuple(r) for r in topk.search(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()) == brute_search(rows, 20, 5)
    assert sorted(tuple(r) for r in negatives.mine(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()) == brute_mine(rows, 20)
    assert len(made) == 3 and all(some < 0.6 * every for some, every in made)


def test_huge_components_and_many_labels(spark):
    rows = [(i, [float(np.float32((-1) ** i * 10.0 ** (i % 39))), 1.0, float(i)], i // 3) for i in range(80)]
    assert sorted(tuple(r) for r in topk.search(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()) == brute_search(rows, 10, 5)
    assert sorted(tuple(r) for r in negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()) == brute_mine(rows, 10)


def test_no_vectors_or_queries(spark):
    for rows in ([], [(1, [1.0], 1)], [(20, [1.0], 1)], [(20, None, 1)], [(20, [], 1), (21, [], 1), (22, [], 2)]):
        assert sorted(tuple(r) for r in topk.search(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()) == brute_search(rows, 20, 5)
        assert sorted(tuple(r) for r in negatives.mine(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()) == brute_mine(rows, 20)


# 3, 8: pages of markup that is never closed ---------------------------------------------------------------------------
@pytest.mark.parametrize("piece", ["<link rel=canonical ", "<link rel='a canonical' ", "<script>", "<!--", "<html lang", "<", "<meta http-equiv=refresh url=", "<link rel=" + " " * 40])
def test_open_markup_is_read_once(spark, piece):
    import time

    page = piece * (1_000_000 // len(piece))
    df = spark.createDataFrame([(1, "http://a.b/c", page), (2, "http://a.b/c", f"<link {page}>")], "page_id long, url string, html string")
    begin = time.time()
    url_filter.links(df).agg(F.count("*")).collect()
    language.page_rows(df).select(F.sum(F.length("text")), F.max("declared")).collect()
    assert time.time() - begin < 20


def test_links_of_pages(spark):
    rows = [
        (1, "http://a.b/c", '<LINK href="/x" REL="next canonical">'), (2, "http://a.b/c/d", "<link rel=canonical href='http://q/r'>"), (3, "http://a.b/c", '<link rel="canonicalx" href="/n"><link rel=\'canonical\' href=/y>'),
        (4, "http://a.b/c", '<link rel="canonical" href="/open"'), (5, "http://a.b/c/d", "<meta http-equiv=refresh content='0; url=z'>"), (6, "http://a.b/c", None), (7, None, '<link rel=canonical href="/x">'),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["target"]) for r in url_filter.links(df).collect())
    assert got == [(1, "http://a.b/x"), (2, "http://q/r"), (3, "http://a.b/y"), (5, "http://a.b/c/z")]
