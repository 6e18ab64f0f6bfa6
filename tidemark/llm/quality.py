"""Operator 2: quality rules whose cutoffs are chosen under a bound on false rejection.

Each rule scores a document; a document at or over the rule's cutoff is rejected. Cutoffs come from a fixed grid.
For each stratum, rule and cutoff, the labelled good documents are a holdout: n of them, x at or over the cutoff. The
exact binomial test of "this cutoff rejects at least a share of ``risk`` / rules of good documents" has the p-value
P(Binomial(n, risk / rules) <= x). The cutoffs of a rule are nested, so they are tested in fixed sequence from the
laxest on, each at the sequence's whole level, until one fails; the last safe one is used. The ``level`` is divided
over the sequences of all strata and rules; a sequence that ends with every cutoff safe gives its part to the others
(Holm's principle for sequences). So all rules together reject at most ``risk`` of a stratum's good documents, in all
strata at once, with probability ``1 - level``. A stratum with fewer good labels than ``labels_needed`` gets no cutoff
and keeps its documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = ("symbol_share", "capital_share", "bang_share", "dup_line_share", "repeat_share")
#: Cutoffs that every rule tries, the strictest first.
GRID = (0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
_SYMBOL = re.compile(r"[#*$%&|<>]+")
_SPACE = b" \t\n\x0b\x0c\r"
#: Share of a stratum's good documents that all rules together may reject, and the probability of more.
RISK, LEVEL = 0.05, 0.05
FEATURES = "doc_id long, row long, stratum string, " + ", ".join(f"{c} long" for c in BASE) + ", " + ", ".join(f"{c} double" for c in RULES)


def repeat_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that the text has twice or more, the first one included."""
    n = len(words) - 2
    if n < 2:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    many = Counter(windows)
    if len(many) == n:
        return 0
    total = reach = 0
    for i, w in enumerate(windows):
        if many[w] > 1:
            total += i + 3 - max(reach, i)
            reach = i + 3
    return total


def measures(text: str) -> tuple:
    """The five base counts, then the five rule scores."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    seen, dup, lines = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.strip(_SPACE):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeat = repeat_words(words)
    ascii_only = raw.translate(None, _NOT_LETTER)
    capitals = len(ascii_only.translate(None, _LOWER))
    return (
        n, chars, symbols, dup, repeat,
        symbols / max(1, chars), capitals / max(1, len(ascii_only)), raw.count(b"!") / max(1, n), dup / max(1, lines), repeat / max(1, n),
    )


_LOWER = bytes(range(97, 123))
_NOT_LETTER = bytes(i for i in range(256) if not (65 <= i <= 90 or 97 <= i <= 122))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [*BASE, *RULES]
    for b in common.steps(batches):
        got = list(zip(*map(measures, b.column("text").to_pylist()), strict=True))
        cols = [pa.array(x, pa.int64() if i < len(BASE) else pa.float64()) for i, x in enumerate(got)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), b.column("stratum"), *cols], ["doc_id", "row", "stratum", *names])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", row_col: str | None = None) -> DataFrame:
    """A row for each document: base counts and rule scores of its whole text (null: none); a null stratum is ''. ``row``
    is ``row_col``, a long that tells rows with one id apart (null without it)."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.col(row_col) if row_col else F.lit(None)).cast("long").alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
    )
    return rows.mapInArrow(_features, FEATURES)


def binomial_tail(x: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= x), summed exactly in logarithms."""
    if x >= n:
        return 1.0
    k = np.arange(0, x + 1)
    logs = np.fromiter(
        (math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in k.tolist()), float
    )
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def labels_needed(strata: int, risk: float = RISK, level: float = LEVEL) -> int:
    """Good labels from which a cutoff that rejects none of them is safe, before any level is passed on."""
    return math.ceil(math.log(level / (strata * len(RULES))) / math.log1p(-risk / len(RULES)))


def sequences(p_values: list[list[float]], level: float) -> list[int]:
    """How many leading tests of each sequence are rejected, at ``level`` for all of them together."""
    done, open_ = [0] * len(p_values), set(range(len(p_values)))
    while open_:
        each = level / len(open_)
        for i in open_:
            while done[i] < len(p_values[i]) and p_values[i][done[i]] <= each:
                done[i] += 1
        ended = {i for i in open_ if done[i] == len(p_values[i])}
        if not ended:
            break
        open_ -= ended
    return done


def _safe(risk: float, level: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        share, lax = risk / len(RULES), range(len(GRID) - 1, -1, -1)
        p = [[binomial_tail(x, r["n"], share) if (x := r[f"x{i}_{j}"]) <= share * r["n"] else 1.0 for j in lax] for r in rows for i in range(len(RULES))]
        cut = [GRID[-k] if k else None for k in sequences(p, level)]
        cols = [pa.array(cut[i :: len(RULES)], pa.float64()) for i in range(len(RULES))]
        yield pa.RecordBatch.from_arrays([pa.array([r["stratum"] for r in rows], pa.string()), *cols], ["stratum", *RULES])

    return run


def cutoffs(scored: DataFrame, labels: DataFrame, *, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """stratum and a cutoff for each rule (null: none is safe). One task holds the counts, a row for each stratum.

    ``labels``: doc_id, quality. A document counts once, as good if any of its labels is 1; null labels don't count.
    """
    good = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .where("quality = 1")
        .select("doc_id")
    )
    held = scored.join(good, "doc_id", "left_semi")
    counts = held.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *(F.count_if(F.col(rule) >= c).alias(f"x{i}_{j}") for i, rule in enumerate(RULES) for j, c in enumerate(GRID)),
    )
    counts = common.stored(counts, "holdout")
    return counts.coalesce(1).mapInArrow(_safe(risk, level), "stratum string, " + ", ".join(f"{r} double" for r in RULES))


def judge(
    docs: DataFrame, labels: DataFrame, *, risk: float = RISK, level: float = LEVEL,
    id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", row_col: str | None = None,
) -> DataFrame:
    """doc_id, base counts, base_failed, kept and the rules that rejected it (``rejected_by``), for every document.

    base_failed: under 50 words, or more than half of them repeated. Null or empty text: all counts 0, failed. Rows with
    one id are judged each by its own text; a null id is judged too but never labelled. Empty tables give empty results;
    without labels the method rejects nothing. Ties with a cutoff are rejected. Only the named columns are read; ``row_col``,
    if given, comes back as ``row``.
    """
    scored = common.stored(features(docs, id_col, text_col, stratum_col, row_col), "features")
    cut = cutoffs(scored, labels, risk=risk, level=level).select("stratum", *(F.col(r).alias(f"cut_{r}") for r in RULES))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    hit = F.array_compact(F.array(*(F.when(F.col(r) >= F.col(f"cut_{r}"), F.lit(r)) for r in RULES)))
    return (
        scored.join(cut, "stratum", "left")
        .withColumn("base_failed", failed)
        .withColumn("rejected_by", F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(hit))
        .select("doc_id", *(["row"] if row_col else []), *BASE, "base_failed", (F.size("rejected_by") == 0).alias("kept"), F.array_join("rejected_by", ",").alias("rejected_by"))
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return judge(docs, labels)
