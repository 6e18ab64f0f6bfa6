"""Co-occurrence, cosine distances, semantic mapping of topics between windows, vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import min_max, q6
from tidemark.scratch import stored


def cooccurrence(doc_words: DataFrame, vocabulary: DataFrame, diagonal: bool = False) -> DataFrame:
    """w1, w2, value: sum over documents of tf1 * tf2, for w1 < w2 (and equal ones on request). Words outside the
    vocabulary go before the join, so a document contributes at most the vocabulary's square."""
    x = doc_words.join(vocabulary.select("word"), "word", "left_semi").groupBy("doc_id", "word").agg(F.sum("tf").alias("tf"))
    a, b = x.select("doc_id", F.col("word").alias("w1"), F.col("tf").alias("f1")), x.select("doc_id", F.col("word").alias("w2"), F.col("tf").alias("f2"))
    on = F.col("w1") <= F.col("w2") if diagonal else F.col("w1") < F.col("w2")
    return a.join(b, "doc_id").where(on).groupBy("w1", "w2").agg(F.sum(F.col("f1") * F.col("f2")).alias("value"))


def cosine_distances(sparse: DataFrame) -> DataFrame:
    """a < b, distance of sparse vectors (row, col, v), by a join on the column. Rows that share none are at distance 1
    and not listed."""
    norm = sparse.groupBy("row").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("n"))
    a, b = sparse.toDF("a", "col", "va"), sparse.toDF("b", "col", "vb")
    dot = a.join(b, "col").where("a < b").groupBy("a", "b").agg(F.sum(F.col("va") * F.col("vb")).alias("dot"))
    return dot.join(norm.toDF("a", "na"), "a").join(norm.toDF("b", "nb"), "b").select("a", "b", (1 - F.col("dot") / (F.col("na") * F.col("nb"))).alias("distance"))


def symmetric(upper: DataFrame, row: str = "w1", col: str = "w2", value: str = "value") -> DataFrame:
    """(row, col, v) with both halves of an upper triangle and its diagonal."""
    x = upper.select(F.col(row).alias("row"), F.col(col).alias("col"), F.col(value).cast("double").alias("v"))
    return x.unionByName(x.where("row <> col").select(F.col("col").alias("row"), F.col("row").alias("col"), "v"))


def source_vectors(theta: DataFrame, most: int = 1000) -> DataFrame:
    """source, topic_id, weight: summed topic weights of the ``most`` sources with the most rows (ties by source).

    ``theta``: source, topic_id, topic_weight. Rows of a null source are nobody's; a null weight counts as a row, not as
    weight. The sums are combined before any shuffle, so a hot source is a row for each topic and task.
    """
    x = theta.where("source is not null").groupBy("source", "topic_id").agg(F.sum("topic_weight").alias("weight"), F.count("*").alias("n"))
    x = stored(x, "sources")
    top = x.groupBy("source").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "source").limit(most)
    return x.join(F.broadcast(top.select("source")), "source", "left_semi").select("source", "topic_id", "weight")  # ``most`` rows at most


def word_cells(one: DataFrame, two: DataFrame, distances: DataFrame) -> DataFrame:
    """t1, t2, i, j, rw, cw, s of two windows' topics (topic_id, word, w): pairs of a word of either whose similarity is
    over 0; all others have 0. A join on the similar pairs of words (``distances``: a, b, distance, both ways); equal words
    have 1, listed or not."""
    alike = distances.where("a <> b and distance < 1").select(F.col("a").alias("i"), F.col("b").alias("j"), (1 - F.col("distance")).alias("s"))
    equal = one.select(F.col("word").alias("i"), F.col("word").alias("j"), F.lit(1.0).alias("s")).distinct()
    x = one.select(F.col("topic_id").alias("t1"), F.col("word").alias("i"), F.col("w").alias("rw")).join(alike.unionByName(equal), "i")
    cells = x.join(two.select(F.col("topic_id").alias("t2"), F.col("word").alias("j"), F.col("w").alias("cw")), "j")
    return cells.withColumn("s", F.round("s", 12)).where("s > 0").select("t1", "t2", "i", "j", "rw", "cw", "s")


def _all_pairs(scores: DataFrame, one: DataFrame, two: DataFrame) -> DataFrame:
    """``scores`` with 0 for the pairs of topics it lacks. The names of one model's topics pass through the driver."""
    names = [r["topic_id"] for r in two.select("topic_id").distinct().orderBy("topic_id").collect()]
    every = one.select(F.col("topic_id").alias("t1")).distinct().withColumn("t2", F.explode(F.array(*map(F.lit, names)).cast("array<string>")))
    return every.join(scores, ["t1", "t2"], "left").fillna(0.0, "score")


def mutual_similarity(cells: DataFrame, one: DataFrame, two: DataFrame, at_least: float) -> DataFrame:
    """t1, t2, score: weighted similarity of ``word_cells`` at or over a threshold, as a share of all; 0 without any."""
    x = F.col("rw") * F.col("cw") * F.col("s")
    scores = cells.groupBy("t1", "t2").agg((F.sum(F.when(F.col("s") >= at_least, x).otherwise(0.0)) / F.sum(x)).alias("score"))
    return _all_pairs(scores, one, two)


def semantic_mapping(cells: DataFrame, one: DataFrame, two: DataFrame, same: float = 0.97, base: float = 0.8) -> DataFrame:
    """t1, t2, score of all pairs of topics, by their ``word_cells``.

    Over each pair of topics: the best column of each row and best row of each column (the first on ties) count fully,
    if their similarity is over the mean less a deviation of the bests; cells at ``same`` or over count less ``base``. Words
    without a cell have 0 as best, so only their number enters mean and deviation.
    """
    pair = ["t1", "t2"]
    side = lambda k: Window.partitionBy(*pair, k)
    all_of = Window.partitionBy(*pair)
    size = lambda d, t, n: d.groupBy(F.col("topic_id").alias(t)).agg(F.count("*").alias(n))
    x = cells.join(size(one, "t1", "ri_n"), "t1").join(size(two, "t2", "rj_n"), "t2")
    x = x.withColumn("ri", F.row_number().over(side("i").orderBy(F.desc("s"), "j"))).withColumn("rj", F.row_number().over(side("j").orderBy(F.desc("s"), "i")))
    for r in ("ri", "rj"):
        best, n = F.when(F.col(r) == 1, F.col("s")), F.col(f"{r}_n")
        x = x.withColumn("mean", F.sum(best).over(all_of) / n)
        off = F.sum((best - F.col("mean")) * (best - F.col("mean"))).over(all_of) + (n - F.count(best).over(all_of)) * F.col("mean") * F.col("mean")
        limit = F.round(F.col("mean") - F.sqrt(off / n), 12)
        x = x.withColumn(f"{r}_part", F.when((F.col(r) == 1) & (F.col("s") > limit), F.col("rw") * F.col("cw") * F.col("s")).otherwise(0.0))
    true = F.sum(F.when(F.col("s") >= same, F.col("rw") * F.col("cw") * (F.col("s") - base)).otherwise(0.0))
    whole = F.sum(F.col("ri_part") + F.col("rj_part"))
    return _all_pairs(x.groupBy(*pair).agg(F.when(whole > 0, true / whole).otherwise(0.0).alias("score")), one, two)


def at_thresholds(scores: DataFrame, thresholds: list[float]) -> DataFrame:
    """threshold, t1, t2 of each mapping whose score is over a threshold."""
    return scores.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds)))).where("score > threshold")


def delta_words(mapped: DataFrame, one: DataFrame, two: DataFrame) -> DataFrame:
    """threshold, t1, t2, delta_words (sorted), delta_count: words of the first topic's list that the second's lacks.

    ``one``, ``two``: topic_id, word. A mapping of equal lists has an empty list, a topic without words too.
    """
    pairs = mapped.select("t1", "t2").distinct()
    words = pairs.join(one.select(F.col("topic_id").alias("t1"), "word").distinct(), "t1")
    missing = words.join(two.select(F.col("topic_id").alias("t2"), "word"), ["t2", "word"], "left_anti")
    lists = missing.groupBy("t1", "t2").agg(F.array_sort(F.collect_list("word")).alias("delta_words"))  # a topic's list is bounded
    out = mapped.join(lists, ["t1", "t2"], "left").withColumn("delta_words", F.coalesce("delta_words", F.array().cast("array<string>")))
    return out.select("threshold", "t1", "t2", "delta_words", F.size("delta_words").alias("delta_count"))


def validate_mapping(
    mapped: DataFrame, theta_one: DataFrame, theta_two: DataFrame, topics: int, thresholds: list[float], dates: tuple | None = None, least: float = 0.05
) -> DataFrame:
    """threshold, coverage (mapped topics over all), mean document Jaccard of the mappings, and that scaled to [0, 1].

    ``theta_one``, ``theta_two``: document_id, topic_id, topic_weight, datetime of either window's model. Only documents
    dated within ``dates`` (first and last, included: the second window's beginning and the first's end) with a weight of
    ``least`` or more count; without ``dates`` all do. Two topics without documents overlap by 0. A threshold that nothing is
    mapped at has coverage and Jaccard 0 and no scaled score.
    """

    def ids(theta: DataFrame) -> DataFrame:
        x = theta.where(F.col("topic_weight") >= least)
        if dates is not None:
            x = x.where(F.col("datetime").between(F.lit(dates[0]).cast("timestamp_ntz"), F.lit(dates[1]).cast("timestamp_ntz")))
        return x.select("document_id", "topic_id").distinct()

    one, two = ids(theta_one), ids(theta_two)
    size = lambda x, t, n: x.groupBy(F.col("topic_id").alias(t)).agg(F.count("*").alias(n))
    pairs = mapped.select("t1", "t2").distinct()
    both = pairs.join(one.toDF("d", "t1"), "t1").join(two.toDF("d", "t2"), ["d", "t2"]).groupBy("t1", "t2").agg(F.count("*").alias("both"))
    j = pairs.join(both, ["t1", "t2"], "left").join(size(one, "t1", "n1"), "t1", "left").join(size(two, "t2", "n2"), "t2", "left").fillna(0, ["both", "n1", "n2"])
    j = j.select("t1", "t2", F.coalesce(F.try_divide("both", F.col("n1") + F.col("n2") - F.col("both")), F.lit(0.0)).alias("jaccard"))
    per = mapped.join(j, ["t1", "t2"]).groupBy("threshold").agg((F.count_distinct("t1") / topics).alias("coverage"), q6(F.avg("jaccard")).alias("mean_jaccard"))
    ends = per.agg(F.min("mean_jaccard").alias("lo"), F.max("mean_jaccard").alias("hi"))
    scaled = per.crossJoin(F.broadcast(ends)).withColumn("scaled", min_max(F.col("mean_jaccard"), F.col("lo"), F.col("hi"))).drop("lo", "hi")
    every = mapped.sparkSession.createDataFrame([(float(t),) for t in thresholds], "threshold double")
    return every.join(scaled, "threshold", "left").fillna(0.0, ["coverage", "mean_jaccard"])


#: Vectors in a chunk of rows, and queries that meet one at a time.
CHUNK, AT_ONCE = 4096, 256
#: Pairs that are summed up at a time, and nearest rows that a task holds.
PAIRS, MOST_HELD = 1 << 16, 4_000_000
#: More than products of unit vectors are off, together with what nine decimals hide.
NEAR = 3e-9


def nearest(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", most_queries: int = CHUNK) -> DataFrame:
    """query_id, key, similarity, rank: each query's k nearest rows by cosine to nine decimals, ties to the smaller key (a
    whole number; rows without one take no part).

    Rows and queries are stored in chunks (of ``most_queries`` queries), and each chunk meets each: every row is compared
    with every query, in memory of two chunks. Products of matrices find who may be among the k, and only their
    similarities are summed up one component after the other. A task carries its queries' nearest from chunk to chunk, so
    what is shuffled doesn't grow with the pairs of chunks. ``queries`` may be ``vectors`` itself. Null components and those that a shorter vector lacks count
    as 0; a vector without any has no similarity to anything and comes last, one of zeros has NaN and comes first.
    """
    whole = queries is vectors
    both = vectors.select(vector) if whole else vectors.select(vector).unionAll(queries.select(vector))
    width = both.agg(F.max(F.when(F.col(vector).isNotNull(), F.size(vector)))).first()[0] or 0
    rows = _chunks(vectors, key, vector, width, CHUNK)
    asked = rows if whole else _chunks(queries.repartition(max(1, -(-queries.count() // most_queries))), key, vector, width, most_queries)
    pairs = rows.drop("chunk").crossJoin(asked.toDF("chunk", "asked", "q", "q_known"))
    found = pairs.mapInArrow(_among_nearest(k, width), "query_id long, vec_id long, similarity double")
    x = found.select("query_id", F.col("vec_id").alias(key), F.round("similarity", 9).alias("similarity"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), key))
    return x.withColumn("rank", rank).where(F.col("rank") <= k)


def _chunks(vectors: DataFrame, key: str, vector: str, width: int, size: int) -> DataFrame:
    """Stored chunks of up to ``size`` vectors: chunk, ids, mat (components in a row), known (whether it has any)."""
    x = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id is not null")

    def packed(b: pa.Table, number: int) -> pa.RecordBatch:
        b = b.combine_chunks().to_batches()[0]
        vec = b.column("v")
        parts = [np.frombuffer(vec.buffers()[1], np.int32)[vec.offset : vec.offset + len(vec) + 1].astype(np.int64)]
        cells = vec.values.slice(parts[0][0], parts[0][-1] - parts[0][0])
        size = np.diff(parts[0])
        row = np.repeat(np.arange(len(vec)), size)
        place = np.arange(len(row)) - np.repeat(parts[0][:-1] - parts[0][0], size)
        valid = cells.is_valid().to_numpy(zero_copy_only=False)
        mat = np.zeros((len(vec), width))
        mat[row[valid], place[valid]] = cells.to_numpy(zero_copy_only=False)[valid]
        known = np.bincount(row[valid], minlength=len(vec)) > 0
        one = pa.array([0, len(vec)], pa.int32())
        cells = [pa.array([number]), pa.ListArray.from_arrays(one, b.column("id")), pa.array([mat.tobytes()]), pa.array([known.tobytes()])]
        return pa.RecordBatch.from_arrays(cells, ["chunk", "ids", "mat", "known"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, number = None, TaskContext.get().partitionId() << 32
        for b in batches:
            rest = pa.Table.from_batches([b] if rest is None else [*rest.to_batches(), b])
            while rest.num_rows >= size:
                yield packed(rest.slice(0, size), number)
                rest, number = rest.slice(size), number + 1
        if rest is not None and rest.num_rows:
            yield packed(rest, number)

    return stored(x.mapInArrow(cut, "chunk long, ids array<long>, mat binary, known binary"), "chunks", **{"parquet.block.row.count.limit": 2, "parquet.block.size": 4 << 20, "parquet.page.size.row.check.min": 1})


def _summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, from the first component to the last."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def _place(new: np.ndarray) -> np.ndarray:
    """Each row's place in its group; ``new``: where groups begin."""
    at = np.arange(len(new))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _among_nearest(k: int, width: int):
    def side(batch: pa.RecordBatch, i: int, names: tuple[str, str, str]) -> tuple:
        ids, mat, known = (batch.column(n)[i] for n in names)
        ids = ids.values.to_numpy(zero_copy_only=False)
        x = np.frombuffer(mat.as_buffer(), np.float64).reshape(len(ids), width)
        known, n = np.frombuffer(known.as_buffer(), bool), np.sqrt(_summed(x, x))
        plain = known & (n > 1e-140) & (n < 1e140)  # NaN is not
        unit = np.where(plain[:, None], x, 0.0) / np.where(plain, n, 1.0)[:, None]
        return ids, x, known, n, plain, unit

    def meet(rows: tuple, asked: tuple, lo: int, best: tuple) -> tuple:
        """The nearest so far of a part of the queries: query, kind (0 NaN, 1 a number, 2 nothing), value, id."""
        ids, x, known, n, plain, unit = rows
        q_ids, q, q_known, q_n, q_plain, q_unit = (a[lo : lo + AT_ONCE] for a in asked)
        about = q_unit @ unit.T
        if not plain.all():
            about[:, ~plain] = -np.inf
        here = np.flatnonzero(np.isin(q_ids, ids))
        own = ids[None] == q_ids[here][:, None]
        about[here] = np.where(own, -np.inf, about[here])
        least = best[-1]
        new = np.flatnonzero(least == -np.inf)
        if len(new) and len(ids) > k:
            least = least.copy()
            least[new] = np.partition(about[new], len(ids) - k, axis=1)[:, len(ids) - k]
        near = about >= (least - NEAR)[:, None]
        near[:, known & ~plain] = True
        near[~(q_known & q_plain)] = True  # all rows are alike to a query without a component
        near[here] &= ~own
        i, j = np.divmod(np.flatnonzero(near), len(ids))
        parts = [slice(at, at + PAIRS) for at in range(0, len(i), PAIRS)]
        s = np.concatenate([_summed(q[i[p]], x[j[p]]) / (q_n[i[p]] * n[j[p]]) for p in parts] or [np.zeros(0)])
        none = ~(q_known[i] & known[j])
        kind, value = np.where(none, 2, np.where(np.isnan(s), 0, 1)), np.where(none | np.isnan(s), 0.0, s)
        i, kind, value, ids = (np.append(old, a) for old, a in zip(best, (i, kind, value, ids[j]), strict=False))
        order = np.lexsort((ids, -value, kind, i))
        i, kind, value, ids = (a[order] for a in (i, kind, value, ids))
        # of rows that are equally near, the first k; none that k others are nearer than
        place = _place(np.append(True, (i[1:] != i[:-1]) | (kind[1:] != kind[:-1]) | (value[1:] != value[:-1]))[: len(i)])
        i, kind, value, ids = (a[place < k] for a in (i, kind, value, ids))
        least = np.full(len(q_ids), -np.inf)
        last = np.flatnonzero((_place(np.append(True, i[1:] != i[:-1])[: len(i)]) == k - 1) & (kind < 2))
        least[i[last]] = np.where(kind[last] == 1, value[last], np.inf)
        keep = (kind == 0) | (np.where(kind == 1, value, -np.inf) >= least[i] - NEAR)
        return (*(a[keep] for a in (i, kind, value, ids)), least)

    def told(best: dict, asked: dict) -> Iterator[pa.RecordBatch]:
        for (number, lo), (i, kind, value, ids, _) in best.items():
            s = pa.array(np.where(kind == 0, np.nan, value), mask=kind == 2)
            yield pa.RecordBatch.from_arrays([pa.array(asked[number][lo + i]), pa.array(ids), s], ["query_id", "vec_id", "similarity"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, names = {}, {}
        with np.errstate(all="ignore"):
            for b in batches:
                for i in range(b.num_rows):
                    number = b.column("chunk")[i].as_py()
                    rows, asked = side(b, i, ("ids", "mat", "known")), side(b, i, ("asked", "q", "q_known"))
                    names[number] = asked[0].copy()
                    for lo in range(0, len(asked[0]), AT_ONCE):
                        none = np.zeros(0, np.int64)
                        old = best.get((number, lo)) or (none, none, np.zeros(0), none, np.full(len(asked[0][lo : lo + AT_ONCE]), -np.inf))
                        best[number, lo] = meet(rows, asked, lo, old)
                    if sum(len(x[0]) for x in best.values()) > MOST_HELD:
                        yield from told(best, names)
                        best, names = {}, {}
            yield from told(best, names)

    return each


def pool(vectors: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """group, pos, average, greatest at each position of the group's vectors."""
    x = vectors.select(group, F.posexplode(vector).alias("pos", "v"))
    return x.groupBy(group, "pos").agg(F.avg(F.col("v").cast("double")).alias("average"), F.max("v").alias("greatest"))


def pooled_vectors(p: DataFrame, group: str) -> DataFrame:
    """Average and maximum concatenated in order of position."""
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col(c).cast("double").alias("v")))), lambda s: s["v"])
    return p.groupBy(group).agg(F.concat(ordered("average"), ordered("greatest")).alias("vector"))
