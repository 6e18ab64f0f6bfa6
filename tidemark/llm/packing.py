"""Operator 7: packing documents into fixed windows by non-negative least squares on the length histogram.

Every document is cut into whole windows and a rest. The rests' lengths form a histogram (at most ``window`` bins,
whatever the corpus). Shallow combinations of lengths that fill a window are enumerated; non-negative least squares
finds how often to repeat each so that together they use up the histogram; the counts are rounded down, and what is
left is packed greedily, the longest first. The resulting plan (a few slots for each length) maps the r-th piece of
a length to its sequence and offset.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common, tokens
from tidemark.llm.exchange import trim

PIECES = "part int, local long, doc_id long, start long, length int, ids_crc32 long, doc_tokens long"


def _cut(path: str, spaced: bool, end_id: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = tokens.encoder(path, spaced), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for b in common.steps(batches):
            ids, n = enc.encode(b.column("text"))
            ids = np.insert(ids, np.cumsum(n), np.int32(end_id)).astype("<u4", copy=False)
            total = n + 1
            pieces = -(-total // window)
            row = np.repeat(np.arange(len(total)), pieces)
            start = window * (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
            length = np.minimum(window, total[row] - start)
            at = (np.cumsum(total) - total)[row] + start
            crc = [zlib.crc32(ids[i : i + k]) for i, k in zip(at.tolist(), length.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")  # pieces of one length are numbered in the order of the partition
            group, lead, count = np.unique(length[order], return_index=True, return_counts=True)
            local = np.empty(len(row), np.int64)
            local[order] = np.arange(len(row)) + np.repeat(seen[group] - lead, count)
            seen[group] += count
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(row), part, np.int32)), pa.array(local), b.column("doc_id").take(pa.array(row)), pa.array(start),
                    pa.array(length.astype(np.int32)), pa.array(crc, pa.int64()), pa.array(total[row]),
                ],
                ["part", "local", "doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )
        trim()

    return run


def combinations(hist: np.ndarray, window: int, most: int = 20_000) -> list[tuple[tuple[int, int], ...]]:
    """Combinations ((length, times), ...) of at most three different lengths that fill a window exactly.

    The solver's size is bounded by ``most``: those whose scarcest length is commonest come first. It bounds the
    plan, not the data; lengths without a combination go to the greedy step.
    """
    have = np.flatnonzero(hist[: window + 1])
    have = have[have > 0]
    inside = np.zeros(window + 1, bool)
    inside[have] = True
    found: dict[tuple, int] = {}

    def add(*lengths: int) -> None:
        times: dict[int, int] = {}
        for x in lengths:
            times[x] = times.get(x, 0) + 1
        key = tuple(sorted(times.items(), reverse=True))
        found[key] = min(int(hist[x]) // n for x, n in key)

    for a in have[::-1].tolist():
        if a == window:
            add(a)
            continue
        if 2 * a >= window and inside[window - a]:
            add(a, window - a)
        for k in range(2, window // a + 1):  # a length repeated, and what completes it
            rest = window - k * a
            if rest == 0 or inside[rest]:
                add(*[a] * k, *([rest] if rest else []))
            if k >= 8:
                break
    common_ones = have[np.argsort(-hist[have], kind="stable")][:256]
    for a in have[::-1].tolist():
        left = window - a
        b = common_ones[(common_ones <= min(a, left - 1))]
        b = b[inside[left - b]][:24]
        for x in b.tolist():
            add(a, x, left - x)
        if len(found) > 8 * most:
            break
    best = sorted(found.items(), key=lambda kv: (-kv[1], kv[0]))
    return [k for k, n in best if n > 0][:most]


def solve(hist: np.ndarray, combos: list[tuple[tuple[int, int], ...]], rounds: int = 400) -> np.ndarray:
    """x >= 0 with the least squares of A x - hist (accelerated projected gradient; the columns are sparse)."""
    if not combos:
        return np.zeros(0)
    col = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    row = np.array([x for c in combos for x, _ in c])
    val = np.array([n for c in combos for _, n in c], float)
    dot = lambda x: np.bincount(row, val * x[col], len(hist))
    back = lambda r: np.bincount(col, val * r[row], len(combos))
    bound = np.bincount(col, val * np.bincount(row, val * np.ones(len(row)), len(hist))[row], len(combos))
    step = 1 / np.maximum(bound, 1e-9)  # diagonal majoriser of A'A
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        z = np.maximum(0, y - step * back(dot(y) - hist))
        u = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = z + (t - 1) / u * (z - x), z, u
    return x


def plan(hist: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, count, first sequence, offset) that place every piece of the histogram once."""
    left, used, slots, seq = hist.astype(np.int64).copy(), np.zeros(window + 1, np.int64), [], 0

    def place(pattern: list[tuple[int, int]], count: int) -> None:
        nonlocal seq
        at = 0
        for length, times in pattern:
            for _ in range(times):
                slots.append((length, int(used[length]), count, seq, at))
                used[length] += count
                left[length] -= count
                at += length
        seq += count

    combos = combinations(hist, window)
    x = np.floor(solve(hist.astype(float), combos) + 1e-6).astype(np.int64)
    for i in np.argsort(-x, kind="stable"):
        n = min(int(x[i]), *(int(left[a]) // k for a, k in combos[i]))
        if n > 0:
            place(list(combos[i]), n)
    while left.any():
        present = np.flatnonzero(left)
        pattern, room = [], window
        while room > 0:
            k = int(np.searchsorted(present, room, "right")) - 1
            if k < 0:
                break
            a = int(present[k])
            times = min(int(left[a]), room // a)
            pattern.append((a, times))
            room -= a * times
            present = present[:k]
        place(pattern, min(int(left[a]) // k for a, k in pattern))
    return slots


def _place(slots: list[tuple[int, int, int, int, int]]):
    s = np.array(sorted(slots), np.int64).reshape(-1, 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (s[:, 0] << 48) | s[:, 1]
        for b in batches:
            if not b.num_rows:
                continue
            length = b.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, (length << 48) | rank, "right") - 1
            out = [b.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            out[2] = pa.array(length)
            out += [pa.array(s[at, 3] + rank - s[at, 1]), pa.array(s[at, 4])]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(
    docs: DataFrame, tokenizer: str, *, spaced: bool, end_id: int, window: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Place every token of every document in sequences of at most ``window`` tokens.

    Returns a row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Null or empty
    text: the end id alone. Repeated rows are documents of their own; a null id stays null; other columns aren't read.
    An empty table gives no piece. The driver gets the histogram (``window`` rows at most), tasks get the plan.
    """
    spark = docs.sparkSession
    pieces = common.stored(common.texts(docs, id_col, text_col).mapInArrow(_cut(tokenizer, spaced, end_id, window), PIECES), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    hist = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        hist[r["length"]] = r["n"]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("local"))
    slots = plan(hist, window)
    spark.sparkContext.setJobDescription(None)
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        _place(slots), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), spaced=False, end_id=2)
