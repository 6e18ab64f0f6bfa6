"""Lemmas of words that no dictionary has: rules from endings to endings, learned from (word, lemma) tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules that each task is told of; more are joined by ending.
MOST_TOLD = 500_000


def shared_prefix(a: Column, b: Column) -> Column:
    """How many first characters two strings have in common."""
    n = F.least(F.length(a), F.length(b))
    same = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (i <= n) & (F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i)))
    return F.size(same)


def endings(word: Column, least: Column, longest: int) -> Column:
    """The word's last ``least`` to ``longest`` characters, as an array of strings; never the whole word."""
    top = F.least(F.length(word) - 1, F.lit(longest))
    each = F.transform(F.sequence(least, top), lambda k: F.when(k == 0, "").otherwise(F.substring(word, F.length(word) - k + 1, k)))
    return F.when(top >= least, each).otherwise(F.array().cast("array<string>"))


def suffix_rules(pairs: DataFrame, longest: int = 5, least: int = 2, share: float = 0.5) -> DataFrame:
    """ending, strip, add, n, total: what to take off and put on a word with that ending.

    ``pairs``: word, lemma, each word once or more (counted alike). A pair teaches every ending of the word of up to
    ``longest`` characters that holds all that changes and leaves a character; one whose change is longer than that teaches
    nothing. An ending's rule is the change that most of its pairs make, of equals the shorter ``strip``, then the first
    ``add``; rules that fewer than ``least`` pairs, or less than ``share`` of the ending's, follow are left out. Pairs with
    nulls or empty words are passed over. Counts are combined before the shuffle, so that a common ending is no hot key.
    """
    known = pairs.where("length(word) > 0 and lemma is not null").select("word", "lemma").withColumn("k", shared_prefix(F.col("word"), F.col("lemma")))
    strip = F.length("word") - F.col("k")
    known = known.select(strip.alias("strip"), F.substring("lemma", F.col("k") + 1, F.length("lemma")).alias("add"), F.explode(endings(F.col("word"), strip, longest)).alias("ending"))
    counts = known.groupBy("ending", "strip", "add").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), "strip", "add"))
    rules = counts.groupBy("ending").agg(best.alias("r"), F.sum("n").alias("total"))
    rules = rules.select("ending", "r.strip", "r.add", (-F.col("r.less")).alias("n"), "total")
    return rules.where((F.col("n") >= least) & (F.col("n") >= share * F.col("total")))


def by_rules(words: DataFrame, rules: DataFrame, longest: int = 5) -> DataFrame:
    """``words`` (distinct, not null) with lemma and the ending that decided: the longest that has a rule and leaves a
    character; null where none has. The rules are told to all tasks up to ``MOST_TOLD`` of them; a larger table is joined."""
    told = rules.select(F.col("ending").alias("__ending"), "strip", "add")
    told = F.broadcast(told) if rules.count() <= MOST_TOLD else told
    each = words.select("word", F.explode(endings(F.col("word"), F.lit(0), longest)).alias("__ending")).join(told, "__ending")
    best = each.groupBy("word").agg(F.max_by(F.struct("__ending", "strip", "add"), F.length("__ending")).alias("r"))
    lemma = F.concat(F.expr("substring(word, 1, length(word) - r.strip)"), "r.add")
    return words.join(best.select("word", lemma.alias("lemma"), F.col("r.__ending").alias("ending")), "word", "left")


def lemmatize(tokens: DataFrame, custom: DataFrame, analyser: DataFrame, rules: DataFrame, longest: int = 5) -> DataFrame:
    """``tokens`` with lemma and kind: the custom dictionary's first (``custom``), then the analyser's (``known``), then by
    rules (``guessed``), else empty (``unknown``). Only words that neither dictionary has are put to the rules. The
    dictionaries (word, word_normal) have a word once; null words are unknown."""
    c = custom.select("word", F.col("word_normal").alias("__custom"))
    a = analyser.select("word", F.col("word_normal").alias("__known"))
    out = tokens.join(c, "word", "left").join(a, "word", "left")
    new = out.where("__custom is null and __known is null and word is not null").select("word").distinct()
    guessed = by_rules(new, rules, longest).select("word", F.col("lemma").alias("__guessed"))
    out = out.join(guessed, "word", "left")
    kind = F.when(F.col("__custom").isNotNull(), "custom").when(F.col("__known").isNotNull(), "known").when(F.col("__guessed").isNotNull(), "guessed")
    out = out.withColumn("kind", kind.otherwise("unknown")).withColumn("lemma", F.coalesce("__custom", "__known", "__guessed", F.lit("")))
    return out.select(*tokens.columns, "lemma", "kind")
