"""Operator 3: language by Bayesian fusion of evidence.

The posterior of a language is proportional to three factors: the likelihood of the text under byte-trigram models; how
often a page of that language declares what this one declares; and a prior of the page's host. Host priors are smoothed
hierarchically: all pages, then the address suffix, then the host, each level worth ``KAPPA`` pages of the one above.
Counts for the last two come from grouped aggregation over all rows, by the language that the text alone suggests.

Where a row's own tag is also a label of the text models, the models are cross-fitted: texts fall into folds by a hash, and
a text is judged by models of the other folds. So its tag counts once, as what it declares, and copies of it don't help.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.url_filter import host_of

#: Hashed trigrams; labelled rows that the text models are fitted on; weight of a level of the hierarchy.
CELLS, SAMPLE_ROWS, KAPPA = 1 << 14, 20_000, 20.0
#: Trigrams that a text counts for at most: they overlap, and so say less than as many independent ones.
TEXT_WEIGHT = 60.0
EVIDENCE = "id long, declared string, host string, suffix string, guess int, logs array<double>"


def trigrams(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Cell of each byte trigram of a batch's texts, A-Z as a-z, and the row that each begins in."""
    data, offs = common.buffer_of(b.column("text"))
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = low[:-2] | low[1:-1] << 8 | low[2:] << 16
    row = np.searchsorted(offs, np.arange(len(code)), "right") - 1
    ok = offs[row + 1] - np.arange(len(code)) >= 3
    cell = (common.mix(code[ok].astype(np.uint64)) & np.uint64(CELLS - 1)).astype(np.int64)
    return cell, row[ok]


def _counts(names: list[str]):
    place = {n: i for i, n in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.steps(batches):
            cell, row = trigrams(b)
            lang = np.array([place[x] for x in b.column("label").to_pylist()], np.int64)
            fold = b.column("fold").to_numpy(zero_copy_only=False).astype(np.int64)
            code, n = np.unique((fold[row] * len(names) + lang[row]) * CELLS + cell, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], ["code", "n"])

    return run


def _fold(folds: int) -> Column:
    return F.pmod(F.xxhash64("text"), F.lit(folds)).cast("int")


def fit(labelled: DataFrame, folds: int = 1, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages, and for each fold their log trigram probabilities without that fold's texts (with one fold, of all), from
    about ``sample_rows`` rows (text, label) chosen by hash.

    Every label is a language. Driver and tasks hold CELLS numbers (64 KiB) for each language and fold.
    """
    known = labelled.where("label is not null and label <> '' and text is not null").select("text", "label")
    counts = known.groupBy("label").count().collect()
    names, total = sorted(r["label"] for r in counts), sum(r["count"] for r in counts)
    if not names:
        return [], np.zeros((folds, 0, CELLS), np.float32)
    share = min(1.0, sample_rows / total)
    part = known.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).withColumn("fold", _fold(folds))
    rows = part.mapInArrow(_counts(names), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(folds * len(names) * CELLS)
    count[rows["code"].to_numpy()] = rows["n"].to_numpy()
    count = count.reshape(folds, len(names), CELLS)
    count = (count.sum(axis=0) - count if folds > 1 else count) + 0.5
    return names, np.log(count / count.sum(axis=2, keepdims=True)).astype(np.float32)


def _evidence(models: np.ndarray):
    size = models.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.steps(batches):
            cell, row = trigrams(b)
            n = np.bincount(row, minlength=b.num_rows)
            fold = b.column("fold").to_numpy(zero_copy_only=False)
            logs = np.zeros((b.num_rows, size))
            for f, model in enumerate(models):
                mine = fold[row] == f if len(models) > 1 else slice(None)
                for i in range(size):
                    logs[:, i] += np.bincount(row[mine], model[i][cell[mine]], b.num_rows)
            logs *= (np.minimum(n, TEXT_WEIGHT) / np.maximum(n, 1))[:, None]
            guess = np.where(n > 0, logs.argmax(axis=1), -1).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * size, pa.int32()), pa.array(logs.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("declared"), b.column("host"), b.column("suffix"), pa.array(guess), lists],
                ["id", "declared", "host", "suffix", "guess", "logs"],
            )

    return run


def _tally(counted: DataFrame, keys: list[str], name: str) -> DataFrame:
    """For each key, the counts by language: at most one entry for each."""
    per = counted.groupBy(*keys, "guess").agg(F.sum("c").alias("c"))
    return per.groupBy(*keys).agg(F.collect_list(F.struct("guess", "c")).alias(name))


def _table(col: pa.Array, size: int) -> np.ndarray:
    """Counts by row and language of a column of lists; a null list counts nothing."""
    out = np.zeros((len(col), size))
    lists = pc.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False)
    entries = pc.list_flatten(col)
    if len(entries):
        lang, n = pc.struct_field(entries, 0), pc.struct_field(entries, 1)
        out[np.repeat(np.arange(len(col)), lists), lang.to_numpy(zero_copy_only=False)] = n.to_numpy(zero_copy_only=False)
    return out


def smoothed(counts: np.ndarray, above: np.ndarray) -> np.ndarray:
    """(counts + KAPPA * shares of the level above) / (all counts + KAPPA), by row."""
    return (counts + KAPPA * above) / (counts.sum(axis=1, keepdims=True) + KAPPA)


def _fuse(names: list[str], declares: np.ndarray, prior: np.ndarray):
    place = {n: i for i, n in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            n = b.num_rows
            logs = b.column("logs").flatten().to_numpy(zero_copy_only=False).reshape(n, len(names)).copy()
            alone = logs.argmax(axis=1)
            logs += np.log(smoothed(_table(b.column("host_n"), len(names)), smoothed(_table(b.column("suffix_n"), len(names)), prior)))
            said = np.array([place.get(x, len(names)) if x else -1 for x in b.column("declared").to_pylist()])
            logs += np.where(said[:, None] >= 0, np.log(declares.T[said]), 0)
            p = np.exp(logs - logs.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            guess = b.column("guess").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id"), b.column("declared"), pa.array([names[i] for i in best]), pa.array(p.max(axis=1)),
                    pa.array([names[i] if g >= 0 else None for i, g in zip(alone, guess, strict=True)], pa.string()),
                ],
                ["id", "declared", "language", "confidence", "text_language"],
            )

    return run


def identify(rows: DataFrame, labelled: DataFrame, folds: int = 1) -> DataFrame:
    """id, declared, language, confidence, text_language for every row.

    ``rows``: id, text, declared, host, suffix; ``labelled``: text, label, with ``folds`` over 1 where these are the rows'
    own tags. Null or empty text leaves the other evidence; an absent declaration (null or '') counts for nothing, one that
    is no known language counts as other; a null host or suffix is ''. Ties go to the first language by name. Without
    labelled rows language is null. Rows with equal ids, or a null one, are judged each for itself, by their whole texts.
    Empty table: no rows. Other columns are not read.
    """
    names, models = fit(labelled, folds)
    out = "id long, declared string, language string, confidence double, text_language string"
    base = rows.select(
        F.col("id").cast("long").alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.lower(F.coalesce(F.col("declared").cast("string"), F.lit(""))).alias("declared"),
        F.coalesce(F.col("host"), F.lit("")).alias("host"),
        F.coalesce(F.col("suffix"), F.lit("")).alias("suffix"),
    ).withColumn("fold", _fold(folds))
    if not names:
        return base.select("id", "declared", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("text_language"))
    size, place = len(names), {n: i for i, n in enumerate(names)}
    seen = common.stored(base.mapInArrow(_evidence(models), EVIDENCE), "evidence")
    counted = seen.groupBy("host", "suffix", "declared", "guess").agg(F.count("*").cast("double").alias("c"))
    counted = common.stored(counted, "counts")
    total = np.zeros(size)
    declares = np.full((size, size + 1), 0.5) + 4 * np.eye(size, size + 1)
    said = F.when(F.col("declared").isin(names) | (F.col("declared") == ""), F.col("declared")).otherwise(F.lit("\x00"))  # what is no language is one thing
    known = counted.where("guess >= 0")
    for r in known.groupBy("guess", said.alias("said")).agg(F.sum("c").alias("c")).collect():
        total[r["guess"]] += r["c"]
        if r["said"]:
            declares[r["guess"], place.get(r["said"], size)] += r["c"]
    prior = (total + 1) / (total + 1).sum()
    declares /= declares.sum(axis=1, keepdims=True)
    hosts = counted.select("host", "suffix").distinct()  # a host without any readable text still has its suffix
    hosts = hosts.join(_tally(known, ["host", "suffix"], "host_n"), ["host", "suffix"], "left").join(_tally(known, ["suffix"], "suffix_n"), "suffix", "left")
    judged = seen.join(hosts, ["host", "suffix"]).select("id", "declared", "guess", "logs", "host_n", "suffix_n")
    return judged.mapInArrow(_fuse(names, declares, prior), out)


def page_rows(pages: DataFrame) -> DataFrame:
    """id, text, declared, host, suffix of raw pages: markup removed, the html tag's lang, the host and its last label.

    What is never closed runs to the end of the page, a tag to the next angle bracket, so that html of any length is read
    once for each expression."""
    hidden = r"(?is)<(script|style|nav)\b.*?(?:</\1\s*+>|\z)|<!--.*?(?:-->|\z)"
    text = F.regexp_replace(F.regexp_replace("html", hidden, " "), r"(?s)<[^<>]*+>", " ")
    tag = F.regexp_extract("html", r"(?is)<html\b[^<>]*+>", 0)
    host = host_of(F.col("url"))
    return pages.select(
        F.col("page_id").alias("id"),
        text.alias("text"),
        F.regexp_extract(tag, r"(?is)\blang\s*+=\s*+[\"']?([a-z]{2,3})", 1).alias("declared"),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its tag is the declaration, its source the host; text models of the other half of the texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"), F.lit("").alias("suffix"))
    return identify(rows, docs.select("text", F.col("lang").alias("label")), folds=2).withColumnRenamed("id", "doc_id")


def op3_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, by text models of the documents."""
    docs, pages = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "pages"))
    return identify(page_rows(pages), docs.select("text", F.col("lang").alias("label"))).withColumnRenamed("id", "page_id")
