"""Suffix rules against plain loops."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lemmas


def learn(pairs, longest, least, share):
    counts = defaultdict(Counter)
    for word, lemma in pairs:
        if not word or lemma is None:
            continue
        k = 0
        while k < min(len(word), len(lemma)) and word[k] == lemma[k]:
            k += 1
        for n in range(len(word) - k, min(len(word) - 1, longest) + 1):
            counts[word[len(word) - n :]][len(word) - k, lemma[k:]] += 1
    out = {}
    for ending, c in counts.items():
        (strip, add), n = min(c.items(), key=lambda x: (-x[1], x[0]))
        if n >= least and n >= share * c.total():
            out[ending] = (strip, add)
    return out


def guess(word, rules, longest):
    for n in range(min(len(word) - 1, longest), -1, -1):
        ending = word[len(word) - n :]
        if ending in rules:
            strip, add = rules[ending]
            return word[: len(word) - strip] + add
    return None


def paradigms(seed, n):
    rng = random.Random(seed)
    stem = lambda: "".join(rng.choice("abкё") for _ in range(rng.randint(1, 5)))
    kinds = [("s", ""), ("ies", "y"), ("ing", "e"), ("ого", "ый"), ("", ""), ("ing", ""), ("ed", "")]
    out = []
    for _ in range(n):
        s, (w, x) = stem(), rng.choice(kinds)
        out.append((s + w, s + x))
    return out


@pytest.mark.parametrize("seed,longest,least,share", [(1, 5, 2, 0.5), (2, 3, 1, 0.0), (3, 6, 3, 0.9)])
@pytest.mark.parametrize("told", [10**6, 0])
def test_rules(spark, monkeypatch, seed, longest, least, share, told):
    monkeypatch.setattr(lemmas, "MOST_TOLD", told)
    pairs = paradigms(seed, 300) + [("went", "go"), ("a", "a"), ("", "x"), (None, "x"), ("x", None), ("b" * 400 + "s", "b" * 400)]
    df = spark.createDataFrame(pairs, "word string, lemma string").repartition(3).withColumn("ending", F.lit("clash"))
    rules = lemmas.suffix_rules(df, longest, least, share)
    want = learn(pairs, longest, least, share)
    assert {r["ending"]: (r["strip"], r["add"]) for r in rules.collect()} == want
    words = sorted({w for w, _ in paradigms(seed + 50, 300)} | {"q", "zzz", "", "c" * 300 + "ies"})
    got = {r["word"]: r["lemma"] for r in lemmas.by_rules(spark.createDataFrame([(w,) for w in words], "word string"), rules, longest).collect()}
    assert got == {w: guess(w, want, longest) for w in words}


def test_lemmatize_in_order(spark):
    words = spark.createDataFrame([("cats", 1), ("dogs", 2), ("mice", 3), ("xyz", 4), (None, 5), ("dogs", 6)], "word string, at int").withColumn("lemma0", F.lit(1))
    table = lambda *r: spark.createDataFrame(list(r), "word string, word_normal string")
    rules = lemmas.suffix_rules(spark.createDataFrame([("hats", "hat"), ("bats", "bat"), ("pigs", "pig")], "word string, lemma string"))
    got = {r["at"]: (r["lemma"], r["kind"]) for r in lemmas.lemmatize(words, table(("mice", "Mouse")), table(("cats", "CAT"), ("mice", "no")), rules).collect()}
    assert got == {1: ("CAT", "known"), 2: ("dog", "guessed"), 3: ("Mouse", "custom"), 4: ("", "unknown"), 5: ("", "unknown"), 6: ("dog", "guessed")}
    none = spark.createDataFrame([], "word string, lemma string")
    assert lemmas.suffix_rules(none).count() == 0 and lemmas.by_rules(words.select("word").distinct().where("word is not null"), lemmas.suffix_rules(none)).where("lemma is not null").count() == 0
