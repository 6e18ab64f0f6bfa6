"""The topic model with phi as a table: neither driver nor closures hold it.

Documents are dealt into blocks of bounded size. In a pass each block gets the rows of phi of its own words, runs the E-step
and sends its counts back by word; the M-step sums and regularises each word's row by itself, and only the topics' totals,
one number each, pass through the driver. Each table is written to the shared folder, so a lost executor costs a step.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.artm import MOST_WORDS, PART_ENTRIES, Settings, add_rows, e_steps, start
from tidemark.scratch import discard, stored

#: Bytes of phi that a block of documents asks for at most (a single document of more words asks for more), and its most
#: entries (a word of a document).
BLOCK_BYTES, BLOCK_ENTRIES = 48 << 20, 1 << 17
#: Blocks from which a word's counts are summed in two steps.
MANY_BLOCKS = 1024
_ROW = "at int, row binary"


class Model:
    """``vocabulary`` (at, word) and ``raw`` (at, row): a word's 32-bit weights over the topics, to be divided by ``totals``."""

    def __init__(self, vocabulary: DataFrame, raw: DataFrame, totals: np.ndarray, perplexity: list[float]):
        self.vocabulary, self.raw, self.totals, self.perplexity = vocabulary, raw, totals, perplexity

    def phi(self, least: float = 1e-6) -> DataFrame:
        """topic_id, word, weight of ``least`` or more."""
        totals = self.totals

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = _matrix(b, len(totals)) / totals
                w, t = np.nonzero(x >= least)
                yield pa.RecordBatch.from_arrays([b.column("at").take(pa.array(w)), pa.array([f"topic_{i}" for i in t], pa.string()), pa.array(x[w, t])], ["at", "topic_id", "weight"])

        return self.raw.mapInArrow(run, "at int, topic_id string, weight double").join(self.vocabulary, "at").select("topic_id", "word", "weight")

    def rows(self) -> DataFrame:
        """word, place, weights: a list of the word's weights."""
        totals = self.totals

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = _matrix(b, len(totals)) / totals
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(totals)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("at"), lists], ["at", "weights"])

        return self.raw.mapInArrow(run, "at int, weights array<double>").join(self.vocabulary, "at").select("word", F.col("at").alias("place"), "weights")

    @classmethod
    def of_rows(cls, rows: DataFrame, topics: int, perplexity: list[float]) -> Model:
        """From ``rows`` (word, place, weights), as a registry has them."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.array(b.column("weights").to_pylist(), float).reshape(b.num_rows, topics)
                yield _rows(b.column("place").to_numpy(), x)

        return cls(rows.select(F.col("place").alias("at"), "word"), rows.select("place", "weights").mapInArrow(run, _ROW), np.ones(topics), perplexity)


def _matrix(b: pa.RecordBatch | pa.Table, topics: int, column: str = "row") -> np.ndarray:
    return np.frombuffer(b"".join(b.column(column).to_pylist()), "<f4").reshape(-1, topics).astype(np.float64)


def _rows(at: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    x = np.ascontiguousarray(x.astype("<f4"))
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([r.tobytes() for r in x], pa.binary())], ["at", "row"])


def _bags(bow: DataFrame, vocabulary: DataFrame, topics: int) -> DataFrame:
    """block, docs, first, at, tf: a block's documents, where each one's entries begin, and the entries. Stored."""
    entries = stored(bow.where("doc_id is not null").join(vocabulary, "word").select("doc_id", "at", F.col("tf").cast("double").alias("tf")), "entries")
    size = min(BLOCK_ENTRIES, max(1024, BLOCK_BYTES // (4 * topics)))
    blocks = max(1, math.ceil(entries.count() / size))

    def pack(t: pa.Table) -> pa.Table:
        doc, at, tf = (t[c].to_numpy() for c in ("doc_id", "at", "tf"))
        order = np.lexsort((at, doc))
        doc, at, tf = doc[order], at[order], tf[order]
        docs, first = np.unique(doc, return_index=True)
        values = [t["block"][0].as_py(), docs.tolist(), np.append(first, len(doc)).tolist(), at.tolist(), tf.tolist()]
        return pa.table({n: pa.array([v], k) for n, k, v in zip(("block", "docs", "first", "at", "tf"), _BAG, values, strict=True)})

    dealt = entries.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
    return stored(dealt.groupBy("block").applyInArrow(pack, "block long, docs array<long>, first array<int>, at array<int>, tf array<double>"), "bags")


_BAG = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64())]


def _with_phi(bags: DataFrame, raw: DataFrame, totals: np.ndarray, each: Callable, schema: str) -> DataFrame:
    """``each`` (block, rows of phi, the entries' places in them) over blocks and the rows of phi that they ask for."""
    needs = bags.select(F.col("block").alias("of"), F.explode(F.array_distinct("at")).alias("at"))
    asked = needs.join(raw, "at").select("of", "at", "row")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = right["at"].to_numpy()
        order = np.argsort(own)
        phi = _matrix(right, len(totals))[order] / totals
        block = {c: np.asarray(left[c][0].values) for c in ("docs", "first", "at", "tf")}
        return each(left["block"][0].as_py(), block, phi, own[order], np.searchsorted(own[order], block["at"]))

    return bags.groupBy("block").cogroup(asked.groupBy("of")).applyInArrow(run, schema)


def _documents(entries: dict, at: np.ndarray, topics: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """A block's documents, some at a time: which, and their entries' at, tf and first."""
    first, i = entries["first"].astype(np.int64), 0
    most = max(1, PART_ENTRIES * 16 // max(16, topics))
    while i < len(first) - 1:
        j = max(i + 1, int(np.searchsorted(first, first[i] + most, "right")) - 1)
        yield slice(i, j), at[first[i] : first[j]], entries["tf"][first[i] : first[j]], first[i:j] - first[i]
        i = j


def _summed(rows: DataFrame, keys: list[str], topics: int) -> DataFrame:
    """Rows of one key added up, one key in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for b in batches:
            key, x = list(zip(*(b.column(c).to_pylist() for c in keys), strict=True)), _matrix(b, topics)
            cuts = [i for i in range(len(key)) if i == 0 or key[i] != key[i - 1]] + [len(key)]
            done = []
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                part = x[i:j].sum(axis=0)
                if key[i] == now:
                    total = total + part
                    continue
                if now is not None:
                    done.append((now, total))
                now, total = key[i], part
            if done:
                yield made(done)
        if now is not None:
            yield made([(now, total)])

    def made(done: list) -> pa.RecordBatch:
        got = _rows(np.array([k[0] for k, _ in done]), np.stack([t for _, t in done]))
        return pa.RecordBatch.from_arrays([*[pa.array([k[i] for k, _ in done], pa.int32()) for i in range(len(keys))], got.column("row")], [*keys, "row"])

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, ", ".join(f"{k} int" for k in keys) + ", row binary")


def _near(pairs: DataFrame, counts: DataFrame, topics: int) -> DataFrame:
    """For each word the sum of value * counts over the words paired with it."""
    both = pairs.select("at1", "at2", "value").unionByName(pairs.where("at1 <> at2").select(F.col("at2").alias("at1"), F.col("at1").alias("at2"), "value"))

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _rows(b.column("at1").to_numpy(), _matrix(b, topics) * b.column("value").to_numpy()[:, None])

    return _summed(both.join(counts.withColumnRenamed("at", "at2"), "at2").select("at1", "value", "row").mapInArrow(scale, _ROW), ["at"], topics)


def _m_step(raw: DataFrame, totals: np.ndarray, counts: DataFrame, near: DataFrame | None, s: Settings, keep: np.ndarray) -> DataFrame:
    """Each word's counts with the regularisers' derivatives, negative ones cut; topics of ``keep`` stay as they were."""
    x = raw.join(counts.withColumnRenamed("row", "counts"), "at", "left")
    x = x.join(near.withColumnRenamed("row", "near"), "at", "left") if near is not None else x.withColumn("near", F.lit(None).cast("binary"))
    zero = bytes(4 * s.topics)
    x = x.select("at", "row", F.coalesce("counts", F.lit(zero)).alias("counts"), F.coalesce("near", F.lit(zero)).alias("near"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            phi, n, c = _matrix(b, s.topics) / totals, _matrix(b, s.topics, "counts"), _matrix(b, s.topics, "near")
            r = np.maximum(n + s.smooth_phi - s.decorrelate * phi * (phi.sum(axis=1, keepdims=True) - phi) + s.coherence * c, 0)
            yield _rows(b.column("at").to_numpy(), np.where(keep, phi, r))

    return x.mapInArrow(run, _ROW)


def _totals(raw: DataFrame, topics: int) -> np.ndarray:
    """Each topic's sum; a task sends one row of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(topics)
        for b in batches:
            total += _matrix(b, topics).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    return sum((np.frombuffer(r["total"]) for r in raw.mapInArrow(run, "total binary").collect()), np.zeros(topics))


def fit(bow: DataFrame, s: Settings, vocabulary: int = MOST_WORDS, pairs: DataFrame | None = None) -> Model:
    """As ``artm.fit``, of any number of topics and words: ``bow`` doc_id, word, tf; ``pairs`` w1, w2, value.

    Rows with a null doc_id are no document's, null words and tf don't count, nor do words outside the vocabulary; a word
    that a document has twice counts twice. No rows: a model without words. Weights are stored in 32 bits, sums made in 64.
    A document of w different words needs 4 * w * topics bytes in its task.
    """
    topics = s.topics
    bow = bow.where("word is not null and tf is not null")
    top = bow.groupBy("word").agg(F.sum("tf").alias("n")).orderBy(F.desc("n"), "word").limit(vocabulary)
    words = stored(top.select((F.row_number().over(Window.orderBy(F.desc("n"), "word")) - 1).cast("int").alias("at"), "word"), "vocabulary")  # bounded
    bags = _bags(bow, words, topics)
    linked = None
    if s.coherence and pairs is not None:
        one, two = words.toDF("at1", "w1"), words.toDF("at2", "w2")
        linked = stored(pairs.join(one, "w1").join(two, "w2").select("at1", "at2", F.col("value").cast("double").alias("value")), "linked")

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column("word").to_pylist()
            for lo in range(0, len(names), 1024):
                x = start(names[lo : lo + 1024], topics, scaled=False)
                yield _rows(b.column("at").to_numpy()[lo : lo + 1024], x)

    def counted(block, entries, phi, own, at) -> pa.Table:
        total, log = np.zeros_like(phi), 0.0
        for _, places, tf, first in _documents(entries, at, topics):
            _, counts, one = e_steps(phi, places, tf, first, s)
            add_rows(total, places, counts)
            log += one.sum()
        got = _rows(own, total)
        n = len(own)
        return pa.table({
            "at": pa.concat_arrays([got.column("at"), pa.array([-1], pa.int32())]), "part": pa.array(np.full(n + 1, block % 32, np.int32)),
            "row": pa.concat_arrays([got.column("row"), pa.array([b""], pa.binary())]), "log": pa.array(np.append(np.zeros(n), log)), "n": pa.array(np.append(np.zeros(n), entries["tf"].sum())),
        })

    raw = stored(words.mapInArrow(begin, _ROW), "phi")
    totals, likelihood, many = np.maximum(_totals(raw, topics), 1e-300), [], bags.count() > MANY_BLOCKS
    for _ in range(s.passes):
        out = stored(_with_phi(bags, raw, totals, counted, "at int, part int, row binary, log double, n double"), "counts")
        log, n = out.where("at < 0").agg(F.sum("log"), F.sum("n")).first()
        likelihood.append(math.exp(-log / n) if n else math.nan)
        parts = out.where("at >= 0")
        counts = _summed(_summed(parts.select("at", "part", "row"), ["at", "part"], topics) if many else parts, ["at"], topics)
        counts = stored(counts.select("at", "row"), "sums")
        near = None if linked is None else _near(linked, counts, topics)
        keep = np.zeros(topics, bool)
        after = stored(_m_step(raw, totals, counts, near, s, keep), "phi")
        new = _totals(after, topics)
        if (new <= 0).any():  # a topic that loses all keeps phi
            discard(after)
            keep = new <= 0
            after = stored(_m_step(raw, totals, counts, near, s, keep), "phi")
            new = np.where(keep, 1.0, new)
        discard(raw, out, counts)
        raw, totals = after, new
    return Model(words, raw, totals, likelihood)


def transform(bow: DataFrame, model: Model, s: Settings, least: float = 1e-4) -> DataFrame:
    """document_id, topic_id, topic_weight of documents with a known word, seen or not."""

    def thetas(block, entries, phi, own, at) -> pa.Table:
        ids, topics, weights = [], [], []
        for which, places, tf, first in _documents(entries, at, s.topics):
            theta, _, _ = e_steps(phi, places, tf, first, s)
            d, t = np.nonzero(theta >= least)
            ids += entries["docs"][which][d].tolist()
            topics += [f"topic_{k}" for k in t.tolist()]
            weights += theta[d, t].tolist()
        return pa.table({"document_id": pa.array(ids, pa.int64()), "topic_id": pa.array(topics, pa.string()), "topic_weight": pa.array(weights, pa.float64())})

    bags = _bags(bow.where("word is not null and tf is not null"), model.vocabulary, s.topics)
    return _with_phi(bags, model.raw, model.totals, thetas, "document_id long, topic_id string, topic_weight double")
