"""Topic words, topic weights, combinations of topics, coherence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dictionary import dealt_rows
from tidemark.scratch import small_splits, stored


def topic_index(topic_id: Column) -> Column:
    return F.split_part(topic_id, F.lit("_"), F.lit(2)).cast("int")


def ranked(phi: DataFrame, least: float = 1e-4, most: int = 100) -> DataFrame:
    """phi over ``least``, its ``most`` heaviest words for each topic, with their rank; ties by word.

    Weights are counted first, in steps of a sixteenth of a power of two: words of a step that ``most`` words are over can't
    rank, so that only the few others are sorted. phi is read twice.
    """
    step = F.coalesce(F.floor(F.nanvl(F.log2("weight") * 16, F.lit(float("inf")))), F.lit(-(1 << 40)))  # 0 and less come last
    heavy = phi.where(F.col("weight") > least).withColumn("__step", step)
    over = F.sum("n").over(Window.partitionBy("topic_id").orderBy(F.desc("__step"))) - F.col("n")
    counts = heavy.groupBy("topic_id", "__step").agg(F.count("*").alias("n")).withColumn("over", over)
    last = counts.where(F.col("over") < most).groupBy(F.col("topic_id").alias("__topic")).agg(F.min("__step").alias("__last"))
    heavy = heavy.join(F.broadcast(last), F.col("topic_id").eqNullSafe(F.col("__topic")) & (F.col("__step") >= F.col("__last")))
    rank = F.row_number().over(Window.partitionBy("topic_id").orderBy(F.desc("weight"), "word"))
    return heavy.select(*phi.columns).withColumn("rank", rank).where(F.col("rank") <= most)


def top_words(phi: DataFrame, least: float = 1e-4, most: int = 100, in_name: int = 5) -> DataFrame:
    """topic_id, name (the first words), topic_words (array of word and weight), n_words."""
    r = ranked(phi, least, most)
    words = F.transform(F.array_sort(F.collect_list(F.struct("rank", "word", "weight"))), lambda x: F.struct(x["word"].alias("word"), x["weight"].alias("weight")))
    out = r.groupBy("topic_id").agg(words.alias("topic_words"))
    return out.withColumn("name", F.array_join(F.transform(F.slice("topic_words", 1, in_name), lambda x: x["word"]), ", ")).withColumn("n_words", F.size("topic_words"))


def theta_topk(theta: DataFrame, topics: int, slices: int = 1, least: float = 1e-4) -> DataFrame:
    """Per document and slice of topics, the max(topics // 3 // slices, 10 // slices) heaviest; lighter than least go."""
    keep, width = max(topics // 3 // slices, 10 // slices), -(-topics // slices)
    part = F.floor(topic_index(F.col("topic_id")) / width)
    x = theta.where(F.col("topic_weight") >= least).withColumn("slice", part)
    rank = F.row_number().over(Window.partitionBy("document_id", "slice").orderBy(F.desc("topic_weight"), "topic_id"))
    return x.withColumn("rank", rank).where(F.col("rank") <= keep)


def word_jaccards(phi: DataFrame, most: int = 100) -> DataFrame:
    """topic_1 < topic_2, jaccard of each pair's ``most`` heaviest words. Common words are counted by a join on the word;
    a pair without any has 0. Topics are few: their pairs are at most the square of their number."""
    top = stored(ranked(phi, 0.0, most).select("topic_id", "word"), "top")
    size = top.groupBy("topic_id").agg(F.count("*").alias("n"))
    a, b = (size.select(F.col("topic_id").alias(f"topic_{i}"), F.col("n").alias(f"n{i}")) for i in (1, 2))
    x, y = (top.select(F.col("topic_id").alias(f"topic_{i}"), "word") for i in (1, 2))
    both = x.join(y, "word").where("topic_1 < topic_2").groupBy("topic_1", "topic_2").agg(F.count("*").alias("both"))
    pairs = a.join(b, F.col("topic_1") < F.col("topic_2")).join(both, ["topic_1", "topic_2"], "left").withColumn("both", F.coalesce("both", F.lit(0)))
    return pairs.select("topic_1", "topic_2", (F.col("both") / (F.col("n1") + F.col("n2") - F.col("both"))).alias("jaccard"))


def mean_word_jaccard(phi: DataFrame, most: int = 100) -> DataFrame:
    """Number of topic pairs, and their mean Jaccard of words."""
    return word_jaccards(phi, most).agg(F.count("*").alias("pairs"), F.avg("jaccard").alias("mean_jaccard"))


def document_topics(theta: DataFrame, least: float = 0.1) -> DataFrame:
    """document_id, topics (sorted): the topics that a document has with a weight of ``least`` or more, if any."""
    x = theta.where((F.col("topic_weight") >= least) & F.col("document_id").isNotNull() & F.col("topic_id").isNotNull())
    return x.groupBy("document_id").agg(F.array_sort(F.collect_list("topic_id")).alias("topics"))


def common_documents(listed: DataFrame) -> DataFrame:
    """topic_1 < topic_2, common_docs: documents (``document_topics``) with both. Pairs are counted where the lists stand."""
    pairs = F.transform("topics", lambda a: F.transform(F.filter("topics", lambda b: a < b), lambda b: F.struct(a.alias("topic_1"), b.alias("topic_2"))))
    return listed.select(F.inline(F.flatten(pairs))).groupBy("topic_1", "topic_2").agg(F.count("*").alias("common_docs"))


def combo_pairs(listed: DataFrame, phi: DataFrame) -> DataFrame:
    """topic_1, topic_2, common_docs of pairs whose words are no more alike than the mean pair's."""
    j = word_jaccards(phi)
    mean = j.agg(F.round(F.avg("jaccard"), 12).alias("mean"))
    alike = j.crossJoin(F.broadcast(mean)).where(F.round("jaccard", 12) > F.col("mean"))
    return common_documents(listed).join(alike, ["topic_1", "topic_2"], "left_anti")


def greedy_combos(pairs: DataFrame, bound: float, at_least: int = 5) -> list[tuple[str, str, int]]:
    """Combinations in order: topic by topic, its pairs from the largest overlap down, while it has sent fewer than
    ``at_least`` or the overlap is over ``bound``. A pair that an earlier topic sent is passed over and doesn't count.
    The driver holds one row for each pair of topics, so at most the square of their number."""
    by: dict[str, list[tuple[int, str]]] = {}
    for a, b, n in pairs.select("topic_1", "topic_2", "common_docs").toLocalIterator():
        by.setdefault(a, []).append((n, b))
        by.setdefault(b, []).append((n, a))
    sent, out = set(), []
    for t in sorted(by):
        new = 0
        for n, o in sorted(by[t], key=lambda x: (-x[0], x[1])):
            if new >= at_least and n <= bound:
                break
            key = (min(t, o), max(t, o))
            if key not in sent:
                sent.add(key)
                new += 1
                out.append((*key, n))
    return out


def combos(theta: DataFrame, phi: DataFrame, least: float = 0.1, at_least: int = 5, listed: DataFrame | None = None) -> DataFrame:
    """topic_1, topic_2, common_docs: combinations of topics with unlike words and many common documents; the bound of
    ``greedy_combos`` is half of the documents (with any topic at ``least``) for each topic. ``listed``: ``document_topics`` that a
    query has stored, else ``theta`` is evaluated once, for them."""
    listed = stored_topics(theta, least) if listed is None else listed
    topics = phi.agg(F.count_distinct("topic_id")).first()[0]
    found = greedy_combos(combo_pairs(listed, phi), listed.count() / max(1, topics) / 2, at_least)
    return listed.sparkSession.createDataFrame(found, "topic_1 string, topic_2 string, common_docs long")


def stored_topics(theta: DataFrame, least: float = 0.1) -> DataFrame:
    """``document_topics``, evaluated once."""
    with small_splits(theta.sparkSession):
        return stored(document_topics(theta, least), "topics")


def combo_documents(theta: DataFrame, found: DataFrame, least: float = 0.1, listed: DataFrame | None = None) -> DataFrame:
    """topic_1, topic_2, document_id: the documents of each combination. ``found``, at most the square of the topics, is told to
    the documents, which aren't shuffled again. ``listed``: as for ``combos``."""
    listed = document_topics(theta, least) if listed is None else listed
    x = listed.select("document_id", "topics", F.explode("topics").alias("topic_1")).join(F.broadcast(found.select("topic_1", "topic_2")), "topic_1")
    return x.select("topic_1", "topic_2", "document_id", F.explode(F.filter("topics", lambda t: t == F.col("topic_2")))).select("topic_1", "topic_2", "document_id")


def kernel(phi: DataFrame, mass: float = 0.3) -> DataFrame:
    """Words with p(topic | word) over ``mass`` (topics alike likely): kernel size, purity and contrast."""
    p = F.col("weight") / F.sum("weight").over(Window.partitionBy("word"))
    return dealt_rows(phi, "word").withColumn("p", p).where(F.col("p") > mass).groupBy("topic_id").agg(F.count("*").alias("kernel_size"), F.sum("weight").alias("purity"), F.avg("p").alias("contrast"))


def coherence(doc_words: DataFrame, phi: DataFrame, n_docs: DataFrame, top: int = 11) -> DataFrame:
    """NPMI over the pairs of each topic's top words; -1 for a pair that never meets; 0 for one that always does.

    Only documents' occurrences of top words are joined; a document has few of them.
    """
    best = ranked(phi, 0.0, top).select("topic_id", "word", "rank")
    hits = doc_words.select("doc_id", "word").distinct().join(best.select("word").distinct(), "word", "left_semi")
    df = hits.groupBy("word").agg(F.count("*").alias("df"))
    joint = hits.toDF("w1", "doc_id").join(hits.toDF("w2", "doc_id"), "doc_id").where("w1 < w2").groupBy("w1", "w2").agg(F.count("*").alias("both"))
    a, b = best.toDF("topic_id", "w1", "r1"), best.toDF("topic_id", "w2", "r2")
    pairs = a.join(b, "topic_id").where("w1 < w2")
    x = pairs.join(df.toDF("w1", "df1"), "w1").join(df.toDF("w2", "df2"), "w2").join(joint, ["w1", "w2"], "left").crossJoin(F.broadcast(n_docs))
    pmi = F.ln(F.col("both") * F.col("n_docs") / (F.col("df1") * F.col("df2")))
    npmi = F.when(F.col("both").isNull(), -1.0).when(F.col("both") == F.col("n_docs"), 0.0).otherwise(pmi / -F.ln(F.col("both") / F.col("n_docs")))
    return x.groupBy("topic_id").agg(F.count("*").alias("pairs"), F.avg(npmi).alias("coherence"))


def diversity(phi: DataFrame, top: int = 25) -> DataFrame:
    r = ranked(phi, 0.0, top)
    return r.agg(F.count_distinct("word").alias("distinct_words"), (F.count_distinct("word") / (F.lit(top) * F.count_distinct("topic_id"))).alias("diversity"))


def tfidf(phi_counts: DataFrame) -> DataFrame:
    """Topics as documents: tf * (ln((1 + n) / (1 + df)) + 1), to unit length by topic, then over the topic's maximum."""
    n = phi_counts.agg(F.count_distinct("topic_id").alias("n_topics"))
    x = dealt_rows(phi_counts.where("word is not null"), "word").withColumn("df", F.count("*").over(Window.partitionBy("word")))
    x = x.crossJoin(F.broadcast(n)).withColumn("w", F.col("tf") * (F.ln((1 + F.col("n_topics")) / (1 + F.col("df"))) + 1))
    by = x.groupBy("topic_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.max("w").alias("top"))
    x = x.join(F.broadcast(by), "topic_id")  # a row for each topic: no task gets a topic's words
    return x.select("topic_id", "word", "tf", (F.col("w") / F.col("norm")).alias("unit"), (F.col("w") / F.col("norm") / (F.col("top") / F.col("norm"))).alias("relative"))
