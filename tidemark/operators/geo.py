"""Gazetteer phrases in documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import clean, words
from tidemark.scratch import stored

#: Names of one automaton, which goes with each task; more are dealt by their first word, and each part is one more pass.
MOST_NAMES = 500_000


class Automaton:
    """Names as sequences of words, compiled to a trie with failure links: one step for each word of a text finds all names
    that end there, whatever their length."""

    def __init__(self, names: list[tuple[str, ...]]):
        self.names = sorted({n for n in names if n})
        self.words: dict[str, int] = {}
        self.next: dict[tuple[int, int], int] = {}
        ends, parent, order = {}, [(0, 0)], []
        for k, name in enumerate(self.names):
            node = 0
            for w in name:
                edge = node, self.words.setdefault(w, len(self.words))
                if edge not in self.next:
                    self.next[edge] = len(parent)
                    parent.append(edge)
                node = self.next[edge]
            ends[node] = k
        depth = [0] * len(parent)
        for node in range(1, len(parent)):
            depth[node] = depth[parent[node][0]] + 1
            order.append(node)
        self.fail, self.out = [0] * len(parent), [()] * len(parent)
        for node in sorted(order, key=depth.__getitem__):
            up, word = parent[node]
            if up:
                back = self.fail[up]
                while back and (back, word) not in self.next:
                    back = self.fail[back]
                self.fail[node] = self.next.get((back, word), 0)
            own = (ends[node],) if node in ends else ()
            self.out[node] = own + self.out[self.fail[node]]

    def scan(self, ids: list[int]) -> Iterator[int]:
        """Numbers of the names that occur, once for each place; ids of words, -1 for those that no name has."""
        node = 0
        for word in ids:
            if word < 0:
                node = 0
                continue
            while node and (node, word) not in self.next:
                node = self.fail[node]
            node = self.next.get((node, word), 0)
            yield from self.out[node]

    def hits(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """key, gram, tf of each row's ``w``. Words no name has are told apart for all rows of a batch at once."""
        for b in batches:
            words = b.column("w")
            offs = words.offsets.to_numpy()
            coded = words.values.slice(offs[0], offs[-1] - offs[0]).dictionary_encode()
            known = np.array([self.words.get(w, -1) for w in coded.dictionary.to_pylist()], np.int64)
            ids = known[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else np.zeros(0, np.int64)
            rows, names, counts = [], [], []
            cuts = (offs - offs[0]).tolist()
            live = np.append(0, np.cumsum(ids >= 0))
            for i in np.flatnonzero(live[cuts[1:]] > live[cuts[:-1]]).tolist():
                for k, n in Counter(self.scan(ids[cuts[i] : cuts[i + 1]].tolist())).items():
                    rows.append(i)
                    names.append("_".join(self.names[k]))
                    counts.append(n)
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(rows, pa.int64())), pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["key", "gram", "tf"])


def phrase_hits(docs: DataFrame, gazetteer: DataFrame, text_cols: list[str], key: str = "doc_id") -> DataFrame:
    """key, location_id, level, tf: phrases of the gazetteer (id, level, name) in any of the texts, however many words long.

    Texts and names are cleaned alike; a phrase does not run from one text into the next. Null texts and names, and names
    without words, hit nothing; locations of one name all hit; rows of one key add up. Empty tables: no rows. The names pass
    through the driver to be compiled, ``MOST_NAMES`` at a time about, and each automaton scans the documents once.
    """
    named = gazetteer.select(F.col("id").alias("location_id"), "level", words(clean(F.col("name"))).alias("w")).where(F.size("w") > 0)
    named = stored(named.withColumn("gram", F.array_join("w", "_")), "names")
    distinct = named.select("w", "gram").distinct()
    parts = max(1, -(-distinct.count() // MOST_NAMES))
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("key"), F.explode(F.array(*map(F.col, text_cols))).alias("t")).where("t is not null").select("key", words(clean(F.col("t"))).alias("w"))
    found = []
    for i in range(parts):
        names = distinct.where(F.pmod(F.xxhash64(F.col("w")[0]), F.lit(parts)) == i).select("w").toArrow()["w"].to_pylist()
        found.append(texts.mapInArrow(Automaton([tuple(n) for n in names]).hits, f"key {kind}, gram string, tf long"))
    grams = reduce(DataFrame.unionByName, found).groupBy("key", "gram").agg(F.sum("tf").alias("tf"))
    return grams.join(named.drop("w"), "gram").select(F.col("key").alias(key), "location_id", "level", "tf")


def bm25(hits: DataFrame, lengths: DataFrame, n_docs: DataFrame, key: str = "doc_id", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """hits with ``weight``: BM25 of the phrase; ``lengths`` has key, n_words, ``n_docs`` one row n_docs, mean_words."""
    df = hits.groupBy("location_id").agg(F.count_distinct(key).alias("df"))
    x = hits.join(df, "location_id").join(lengths, key).crossJoin(F.broadcast(n_docs))
    idf = F.ln(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n_words") / F.col("mean_words")))
    return x.withColumn("weight", idf * tf).drop("df", "n_docs", "mean_words", "n_words")


def with_scores(hits: DataFrame, scores: DataFrame, key: str = "doc_id") -> DataFrame:
    """hits with each document's criterion value; an absent value and 0 are both null."""
    return hits.join(scores.select(key, F.nullif("value", F.lit(0.0)).alias("value")), key, "left")
