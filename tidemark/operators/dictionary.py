"""Dictionaries of words and n-grams, lemmas by lookup, and enrichment of documents with dictionary n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import clean, cleaned_words
from tidemark.scratch import stored


#: Characters of text that a task takes, about: its tables of words grow with these, not with the input.
TASK_CHARS = 6_000_000

#: Rows of a table of counts that a task takes, about.
TASK_ROWS = 500_000

#: Dictionary words that each task is told of to drop other n-grams; more are found by a join.
MOST_TOLD = 500_000


def dealt(docs: DataFrame, key: str, text: str, most: int | None = None) -> DataFrame:
    """``docs`` partitioned by the key, into as many parts as have ``most`` characters each (``TASK_CHARS`` if not given); the
    texts' lengths are added up first. The number is given to Spark, so that it doesn't put small parts together again."""
    chars = docs.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    return _in_parts(docs, key, -(-chars // (most or TASK_CHARS)))


def dealt_rows(rows: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """``rows`` partitioned by the key, as ``dealt``, by their number (``TASK_ROWS`` in a part if not given). What is grouped,
    windowed or joined by the key then takes the same memory in a task however long the table; groups aren't combined before
    the shuffle, so this is for keys with a few rows each."""
    return _in_parts(rows, key, -(-rows.count() // (most or TASK_ROWS)))


def _in_parts(df: DataFrame, key: str, parts: int) -> DataFrame:
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), F.col(key)) if parts > 1 else df.repartition(F.col(key))


def exploded_ngrams(docs: DataFrame, most: int = 3, key: str = "doc_id", text: str = "text", on_clean: bool = True) -> DataFrame:
    """key, n, pos, word: each n-gram of 1 to ``most`` words. Rows stand partitioned by the key: the texts are shuffled, once,
    not their n-grams."""
    base = docs.select(key, F.col(text).alias("t"))
    base = dealt(base, key, "t", max(1, TASK_CHARS // (most * most))) if on_clean else base
    base = base.select(key, (cleaned_words(F.col("t")) if on_clean else F.array_remove(F.split("t", " "), "")).alias("w1"))
    for j in range(2, most + 1):
        base = base.withColumn(f"w{j}", F.slice("w1", j, F.greatest(F.size("w1"), F.lit(1))))
    rows = base.select(key, F.posexplode(F.arrays_zip(*(f"w{j}" for j in range(1, most + 1)))).alias("pos", "w"))
    grams = [F.col("w.w1")]
    for j in range(2, most + 1):
        grams.append(F.concat(grams[-1], F.lit("_"), F.col(f"w.w{j}")))  # null past the end
    each = F.array(*(F.struct(F.lit(n).alias("n"), F.col("pos"), g.alias("word")) for n, g in enumerate(grams, 1)))
    return rows.select(key, F.inline(each)).where("word is not null")


def word_counts(docs: DataFrame, most: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n_gram_len, word_frequency, document_frequency. A document's n-grams are counted where they are, and all counts
    are combined before the shuffle."""
    grams = exploded_ngrams(docs, most, key, text)
    per_doc = grams.groupBy(key, "n", "word").agg(F.count("*").alias("tf"))
    return per_doc.groupBy("word", F.col("n").alias("n_gram_len")).agg(F.sum("tf").alias("word_frequency"), F.count("*").alias("document_frequency"))


def capital_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, and the share of its occurrences that begin with a capital letter."""
    raw = docs.select(key, F.explode(F.split(F.regexp_replace(text, r"[^a-zA-ZА-Яа-я-]", " "), " ")).alias("raw")).where("raw <> ''")
    return raw.groupBy(F.lower("raw").alias("word")).agg(F.avg(F.col("raw").rlike("^[A-ZА-Я]").cast("int")).alias("capital_share"))


def dictionary(counts: DataFrame, n_docs: int | Column, normal: Column, least_share: float = 0.0) -> DataFrame:
    """Relative frequencies, and the same for all words of one normal form."""
    total = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    by = Window.partitionBy("word_normal")
    out = counts.withColumn("word_normal", normal)
    out = out.withColumn("document_frequency_relative", F.col("document_frequency") / total)
    out = out.withColumn("word_normal_frequency", F.sum("word_frequency").over(by)).withColumn("document_normal_frequency", F.sum("document_frequency").over(by))
    return out.where(F.col("document_frequency_relative") > least_share)


def ngramize(docs: DataFrame, dictionary_words: DataFrame, most: int = 3, glue: bool = True, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Cleaned text followed by its n-grams (two words or more) that the dictionary has, by n, then place.

    ``glue``: the first n-gram follows the text without a blank, as stored texts have it. The dictionary is stored; up to
    ``MOST_TOLD`` words of it are told to the tasks, and a larger one is joined.
    """
    known = stored(dictionary_words.select("word").distinct(), "dictionary")
    known = F.broadcast(known) if known.count() <= MOST_TOLD else known
    base = docs.select(key, F.col(text).alias("__text")).repartition(F.col(key)).select(key, clean(F.col("__text")).alias("cleaned"))
    grams = exploded_ngrams(base, most, key, "cleaned", on_clean=False).where("n >= 2")
    kept = grams.join(known, "word", "left_semi")
    listed = kept.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "pos", "word"))), lambda x: x["word"]), " ").alias("grams"))
    sep = "" if glue else " "
    return base.join(listed, key, "left").select(key, F.concat("cleaned", F.when(F.col("grams").isNotNull(), F.concat(F.lit(sep), "grams")).otherwise(F.lit(""))).alias("text_ngramized"))


def lemmatize(tokens: DataFrame, custom: DataFrame, analyser: DataFrame) -> DataFrame:
    """word -> lemma: the custom dictionary first, then the analyser's, else empty; with the source of each."""
    c = custom.select("word", F.col("word_normal").alias("c"))
    a = analyser.select("word", F.col("word_normal").alias("a"))
    out = tokens.join(c, "word", "left").join(a, "word", "left")
    kind = F.when(F.col("c").isNotNull(), "custom").when(F.col("a").isNotNull(), "known").otherwise("unknown")
    return out.withColumn("lemma", F.coalesce("c", "a", F.lit(""))).withColumn("kind", kind).drop("c", "a")
