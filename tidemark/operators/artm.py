"""Additively regularised topic model by expectation-maximisation.

phi (words x topics) goes to the tasks as one array, within a checked size; each task runs the E-step over its documents
and sends sparse counts back, which are summed by word before the driver forms the next phi. Larger models: ``sharded``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest vocabulary, and bytes of phi, that a model may have.
MOST_WORDS, MOST_BYTES = 250_000, 1 << 29

#: Entries (words of documents) whose E-step is run at once.
PART_ENTRIES = 1 << 15


@dataclass(frozen=True)
class Settings:
    topics: int
    passes: int = 10
    inner: int = 5
    smooth_phi: float = 0.0
    smooth_theta: float = 0.0
    decorrelate: float = 0.0
    coherence: float = 0.0


@dataclass
class Model:
    words: list[str]
    phi: np.ndarray
    perplexity: list[float]

    def frame(self, spark) -> DataFrame:
        """topic_id, word, weight over 1e-6."""
        w, t = np.nonzero(self.phi > 1e-6)
        rows = pa.table({"topic_id": pa.array([f"topic_{i}" for i in t]), "word": pa.array([self.words[i] for i in w]), "weight": pa.array(self.phi[w, t])})
        return spark.createDataFrame(rows)


def start(words: list[str], topics: int, scaled: bool = True) -> np.ndarray:
    """Positive values that depend on word and topic alone, each topic adding to 1 if ``scaled``."""
    import zlib

    h = np.array([[zlib.crc32(f"{w}|{t}".encode()) % 10_007 + 1 for t in range(topics)] for w in words], float)
    return h / h.sum(axis=0) if scaled else h


def e_step(phi: np.ndarray, at: np.ndarray, tf: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, float]:
    """theta of one document, its counts by (its words, topics), and its log likelihood."""
    theta, rows = np.full(s.topics, 1 / s.topics), phi[at]
    for _ in range(s.inner):
        p = rows * theta
        total = np.maximum(p.sum(axis=1), 1e-30)
        theta = np.maximum((p * (tf / total)[:, None]).sum(axis=0) + s.smooth_theta, 0)
        theta /= max(theta.sum(), 1e-30)
    p = rows * theta
    total = np.maximum(p.sum(axis=1), 1e-30)
    return theta, p * (tf / total)[:, None], float((tf * np.log(total)).sum())


def e_steps(phi: np.ndarray, at: np.ndarray, tf: np.ndarray, first: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``e_step`` of many documents at once: entries (at, tf), a document's from its place in ``first`` (as many places as
    documents) to the next one's; no document is empty. theta and log likelihood of each document, counts of each entry."""
    if not len(first):
        return np.zeros((0, s.topics)), np.zeros((0, s.topics)), np.zeros(0)
    theta, rows = np.full((len(first), s.topics), 1 / s.topics), phi[at]
    doc = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
    for _ in range(s.inner):
        p = rows * theta[doc]
        p *= (tf / np.maximum(p.sum(axis=1), 1e-30))[:, None]
        theta = np.maximum(np.add.reduceat(p, first, axis=0) + s.smooth_theta, 0)
        theta /= np.maximum(theta.sum(axis=1, keepdims=True), 1e-30)
    p = rows * theta[doc]
    total = np.maximum(p.sum(axis=1), 1e-30)
    p *= (tf / total)[:, None]
    return theta, p, np.add.reduceat(tf * np.log(total), first)


def add_rows(total: np.ndarray, at: np.ndarray, counts: np.ndarray) -> None:
    """Add rows of counts to those of ``total`` at places that may come more than once."""
    if len(at):
        order = np.argsort(at, kind="stable")
        begins = np.flatnonzero(np.diff(at[order], prepend=-1))
        total[at[order][begins]] += np.add.reduceat(counts[order], begins, axis=0)


def m_step(counts: np.ndarray, phi: np.ndarray, s: Settings, near: np.ndarray | float = 0.0) -> np.ndarray:
    """Counts and the regularisers' derivatives, negative ones cut, each topic to 1. A topic that loses all keeps phi.
    ``near``: each word's sum of its co-occurring words' counts."""
    r = counts + s.smooth_phi - s.decorrelate * phi * (phi.sum(axis=1, keepdims=True) - phi) + s.coherence * near
    r = np.maximum(r, 0)
    total = r.sum(axis=0)
    return np.where(total > 0, r / np.where(total > 0, total, 1), phi)


def _known(spark: SparkSession, index: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(pa.table({"word": pa.array(list(index), pa.string()), "at": pa.array(list(index.values()), pa.int32())}))


def _bags(bow: DataFrame, index: dict[str, int]) -> DataFrame:
    known = _known(bow.sparkSession, index)
    return bow.join(known, "word").groupBy("doc_id").agg(F.collect_list(F.struct("at", F.col("tf").cast("double").alias("tf"))).alias("bag"))


def _parts(b: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of a batch, at most ``PART_ENTRIES`` entries (or one document) at a time: ids, at, tf, first."""
    ids, bags = b.column("doc_id").to_pylist(), b.column("bag")
    offs = bags.offsets.to_numpy().astype(np.int64)
    cells = bags.values.slice(offs[0], offs[-1] - offs[0])
    at, tf = (cells.field(c).to_numpy(zero_copy_only=False) for c in ("at", "tf"))
    offs, i = offs - offs[0], 0
    while i < len(ids):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + PART_ENTRIES, "right")) - 1)
        yield ids[i:j], at[offs[i] : offs[j]], tf[offs[i] : offs[j]], offs[i:j] - offs[i]
        i = j


def _dense(cells: DataFrame, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of cells (word * topics + topic) as an array, and all cells with their sums."""
    got = cells.groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    at, v = got["cell"].to_numpy(), got["v"].to_numpy()
    out = np.zeros(shape[0] * shape[1])
    out[at[at >= 0]] = v[at >= 0]
    return out.reshape(shape), at, v


def _cells(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w, t = np.nonzero(total > 1e-9)
    return w * total.shape[1] + t, total[w, t]


def neighbours(pairs: DataFrame, counts: np.ndarray) -> np.ndarray:
    """For each word and topic, the sum of value * count over the words paired with it. ``pairs``: at1, at2, value, each
    pair once, in parts that each add up their own; a pair of a word with itself counts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(counts)
        for b in batches:
            i, j, v = (b.column(c).to_numpy() for c in ("at1", "at2", "value"))
            for begin in range(0, len(v), 4096):
                part = slice(begin, begin + 4096)
                np.add.at(total, i[part], v[part, None] * counts[j[part]])
                other = i[part] != j[part]
                np.add.at(total, j[part][other], v[part][other, None] * counts[i[part][other]])
        cell, v = _cells(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(v)], ["cell", "v"])

    return _dense(pairs.mapInArrow(run, "cell long, v double"), counts.shape)[0]


def fit(bow: DataFrame, s: Settings, vocabulary: int = MOST_WORDS, pairs: DataFrame | None = None) -> Model:
    """``bow``: doc_id, word, tf. The most frequent words make the vocabulary. ``pairs`` (w1, w2, value; each pair once)
    are the co-occurrences that ``coherence`` favours; pairs with a word outside the vocabulary don't count."""
    top = bow.groupBy("word").agg(F.sum("tf").alias("n")).orderBy(F.desc("n"), "word").limit(vocabulary)
    words = [r["word"] for r in top.select("word").collect()]
    if len(words) * s.topics * 8 > MOST_BYTES:
        raise ValueError("phi is too large for one array; sharded.fit keeps it in a table")
    phi, likelihood = start(words, s.topics), []
    index = {w: i for i, w in enumerate(words)}
    # each task sends its own counts of every word it has met, so there are no more tasks than cores
    bags, linked = _bags(bow, index).persist(), None
    dealt = bags.coalesce(bow.sparkSession.sparkContext.defaultParallelism)
    if s.coherence and pairs is not None:
        known = _known(bow.sparkSession, index)
        linked = pairs.join(known.toDF("w1", "at1"), "w1").join(known.toDF("w2", "at2"), "w2").select("at1", "at2", F.col("value").cast("double").alias("value")).persist()
    try:
        for _ in range(s.passes):

            def run(batches: Iterator[pa.RecordBatch], phi=phi) -> Iterator[pa.RecordBatch]:
                total, log, n = np.zeros_like(phi), 0.0, 0.0
                for b in batches:
                    for _, at, tf, first in _parts(b):
                        _, counts, one = e_steps(phi, at, tf, first, s)
                        add_rows(total, at, counts)
                        log, n = log + one.sum(), n + tf.sum()
                cell, v = _cells(total)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(cell, [-1, -2])), pa.array(np.append(v, [log, n]))], ["cell", "v"])

            counts, at, v = _dense(dealt.mapInArrow(run, "cell long, v double"), phi.shape)
            log, n = float(v[at == -1].sum()), float(v[at == -2].sum())
            likelihood.append(float(np.exp(-log / n)) if n else float("nan"))
            phi = m_step(counts, phi, s, 0.0 if linked is None else neighbours(linked, counts))
    finally:
        bags.unpersist()
        if linked is not None:
            linked.unpersist()
    return Model(words, phi, likelihood)


def transform(bow: DataFrame, model: Model, s: Settings, least: float = 1e-4) -> DataFrame:
    """document_id, topic_id, topic_weight of documents, seen or not."""
    phi = model.phi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, topics, weights = [], [], []
            for part, at, tf, first in _parts(b):
                theta, _, _ = e_steps(phi, at, tf, first, s)
                i, t = np.nonzero(theta >= least)
                ids += [part[k] for k in i.tolist()]
                topics += [f"topic_{k}" for k in t.tolist()]
                weights += theta[i, t].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(topics, pa.string()), pa.array(weights, pa.float64())], ["document_id", "topic_id", "topic_weight"])

    bags = _bags(bow, {w: i for i, w in enumerate(model.words)})
    return bags.mapInArrow(run, "document_id long, topic_id string, topic_weight double")
