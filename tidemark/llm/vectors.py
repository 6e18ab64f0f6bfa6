"""Blocks of integer vectors, and exact work on pairs of blocks.

A component x becomes floor(256 x). Rows are dealt to cells by bounded sets of centers, sorted within their cell and cut into
blocks of bounded size; pairs of blocks are chosen from small summaries, and only then meet with their vectors, each pair a
row of its own. So a task holds two blocks at a time, whatever the size of a cell or label.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Vectors in a block at most.
BLOCK = 1024
#: Rows that centers are fitted on, the same for any input: those of least hash of their id.
SAMPLE = 4096
#: Cells at most.
CELLS = 256

#: Squares of larger numbers would overflow.
FINITE = 1e150

NONE = np.iinfo(np.int64).min + 1
_LIMIT = np.iinfo(np.int64).max


class Table:
    """The vectors that take part: ``rows`` (row, vec_id, label, mat, norm), stored; ``width`` components, each of numpy type
    ``kind``.

    Rows with a null id, a null vector or any null or non-finite component take no part (one whose 256-fold reaches
    ``FINITE`` counts as non-finite); a shorter vector counts as zero-padded. Each row stands for itself, so repeated ids are different rows.
    """

    def __init__(self, vectors: DataFrame, id_col: str, vec_col: str, label_col: str | None = None):
        label = F.lit(0).cast("long") if label_col is None else F.col(label_col).cast("long")
        known = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
        known = known.where("vec_id is not null and label is not null").where(F.forall("vec", lambda x: F.abs(x) < F.lit(FINITE / 256)))
        most = F.greatest(F.array_max("vec"), -F.array_min("vec"))
        found = known.agg(F.max(F.size("vec")).alias("width"), F.max(most).alias("most"), F.count("*").alias("n")).first()
        self.width, self.count = int(found["width"] or 0), int(found["n"])
        top = 256 * (found["most"] or 0) + 1
        self.kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8"
        width, kind = self.width, self.kind

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.floor(256 * padded(b.column("vec"), width))
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("vec_id"), b.column("label"), packed_rows(x, kind), pa.array(lengths(x))], ["row", "vec_id", "label", "mat", "norm"])

        rows = known.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "vec")
        self.rows = common.stored(rows.mapInArrow(whole, "row long, vec_id long, label long, mat binary, norm double"), "vectors")

    def sample(self, rows: DataFrame) -> np.ndarray:
        got = rows.select("mat", F.xxhash64("vec_id").alias("h"), "row").orderBy("h", "row").limit(SAMPLE).collect()
        return self.matrix(b"".join(bytes(r["mat"]) for r in got), len(got))

    def matrix(self, data, n: int) -> np.ndarray:
        return np.frombuffer(data, self.kind).reshape(n, self.width).astype(np.float64)


def padded(vec: pa.Array, width: int) -> np.ndarray:
    offs, flat = vec.offsets.to_numpy().astype(np.int64), vec.values.to_numpy(zero_copy_only=False)
    size, out = np.diff(offs), np.zeros((len(vec), width))
    out[np.repeat(np.arange(len(vec)), size), common.ragged(np.zeros(len(vec), np.int64), size)] = flat[offs[0] : offs[-1]]
    return out


def packed_rows(x: np.ndarray, kind: str) -> pa.Array:
    """A binary value for each row."""
    x = np.ascontiguousarray(x.astype(kind))
    offs = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offs), pa.py_buffer(x)])


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Distance of each row to each center."""
    out = (x * x).sum(axis=1)[:, None] + (centers * centers).sum(axis=1) - 2 * x @ centers.T
    return np.sqrt(np.maximum(out, 0))


def centers_of(sample: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` centers of a sample by a few rounds of k-means, from its first different rows."""
    first = np.sort(np.unique(sample, axis=0, return_index=True)[1])[:most]
    centers = sample[first].copy()
    for _ in range(8):
        near = distances(sample, centers).argmin(axis=1)
        for c in np.unique(near):
            centers[c] = sample[near == c].mean(axis=0)
    return centers


def blocks(table: Table, dealt: DataFrame, size: int, name: str, least: int = 1) -> DataFrame:
    """Stored blocks of ``dealt`` (row, vec_id, label, mat, cell, place): rows of one cell, sorted by label and place.

    A block has cell, block, n, lo and hi (least and greatest place), ``least`` (its first few places), ``parts`` (a struct
    of label, n, center, radius for each label), center and radius of all, and the vectors by ascending id: ids, at (rows),
    labels, mat. Radii are rounded up. A hot cell is cut like any other: rows are
    dealt by range of cell, label, place and row.
    """
    width, kind = table.width, table.kind

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, number = None, 0
        for b in batches:
            both = pa.Table.from_batches([rest, b] if rest is not None else [b]).combine_chunks()
            if not both.num_rows:
                continue
            both = both.to_batches()[0]
            cell, lo, out = both.column("cell").to_numpy(), 0, []
            while lo < len(cell):
                hi = min(lo + size, int(np.searchsorted(cell, cell[lo], "right")))
                if hi == len(cell) and hi - lo < size:
                    break
                out.append((lo, hi))
                lo = hi
            rest = both.slice(lo)
            for i, j in out:
                yield made(both.slice(i, j - i), number)
                number += 1
        if rest is not None and rest.num_rows:
            yield made(rest, number)

    def ball(x: np.ndarray) -> tuple[bytes, float]:
        center = x.mean(axis=0)
        return center.tobytes(), float(lengths(x - center).max() * (1 + 1e-9)) + 1e-9

    def made(b: pa.RecordBatch, number: int) -> pa.RecordBatch:
        ids, row, label, place = (b.column(c).to_numpy() for c in ("vec_id", "row", "label", "place"))
        x = np.frombuffer(b"".join(b.column("mat").to_pylist()), kind).reshape(len(ids), width).astype(np.float64)
        order = np.lexsort((row, ids))
        center, radius = ball(x)
        parts = []
        for y in np.unique(label):
            c, r = ball(x[label == y])
            parts.append({"label": int(y), "n": int((label == y).sum()), "center": c, "radius": r})
        mine = int(row[0])  # rows are in one block each, so a block may be named by any
        packed = [np.ascontiguousarray(v[order]).tobytes() for v in (ids, row, label, x.astype(kind))]
        values = [int(b.column("cell")[0].as_py()), mine, len(ids), float(place.min()), float(place.max()), np.sort(place)[:least].tolist(), center, radius, parts, *packed]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _ARROW, strict=True)], _NAMES)

    shuffles = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(1, dealt.count() // (4 * size))
    dealt = dealt.select("vec_id", "row", F.col("label").cast("long"), "mat", F.col("cell").cast("int"), F.col("place").cast("double"))
    dealt = dealt.repartitionByRange(max(wanted, shuffles), "cell", "label", "place", "row").coalesce(wanted)
    return common.stored(dealt.sortWithinPartitions("cell", "label", "place", "row").mapInArrow(cut, _SCHEMA), name)


_NAMES = ["cell", "block", "n", "lo", "hi", "least", "center", "radius", "parts", "ids", "at", "labels", "mat"]
_PART = pa.struct([("label", pa.int64()), ("n", pa.int64()), ("center", pa.binary()), ("radius", pa.float64())])
_ARROW = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.binary(), pa.float64(), pa.list_(_PART), *[pa.binary()] * 4]
_SCHEMA = """cell int, block long, n long, lo double, hi double, least array<double>, center binary, radius double,
 parts array<struct<label:bigint,n:bigint,center:binary,radius:double>>, ids binary, at binary, labels binary, mat binary"""


class Block:
    """A block's vectors out of a row of a batch."""

    def __init__(self, table_width: int, kind: str, batch: pa.RecordBatch, i: int, prefix: str):
        get = lambda c: batch.column(f"{prefix}_{c}")[i].as_buffer()
        self.ids, self.rows, self.labels = (np.frombuffer(get(c), np.int64) for c in ("ids", "at", "labels"))
        self.mat = np.frombuffer(get("mat"), kind).reshape(len(self.ids), table_width).astype(np.float64)
        self.center, self.radius = np.frombuffer(get("center"), "<f8"), batch.column(f"{prefix}_radius")[i].as_py()
        self.norms = lengths(self.mat)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows, as 64-bit integers; those beyond are held at the ends of the range."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * max(1, x.shape[1])
    if most < 1 << 53:
        return (x @ y.T).astype(np.int64)
    big = np.vectorize(int, otypes=[object])
    return np.clip(big(x) @ big(y).T, NONE + 1, _LIMIT).astype(np.int64)


def bounds(x: np.ndarray, norms: np.ndarray, block: Block) -> np.ndarray:
    """No inner product of a row of x with the block's vectors is above this (held at the end of the range, as scores are)."""
    out = x @ block.center + norms * block.radius
    return np.clip(out + 1e-9 * (norms * (lengths(block.center[None]) + block.radius)) + 1, float(NONE), float(_LIMIT))


class Best:
    """The k best (score, id, row) of each of some rows so far: higher scores first, then smaller ids, then smaller rows."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.score, self.id, self.row = np.full((rows, k), NONE), np.zeros((rows, k), np.int64), np.zeros((rows, k), np.int64)

    def open(self, upper: np.ndarray) -> np.ndarray:
        """Rows that a block with these bounds may still change."""
        least = self.score[:, -1].astype(np.float64)
        return np.flatnonzero(upper >= least - 1e-12 * np.abs(least) - 1)

    def add(self, rows: np.ndarray, score: np.ndarray, block: Block) -> None:
        """score: a line for each of ``rows``, a column for each vector of the block; NONE where there is no match."""
        size = score.shape[1]
        k = min(self.k, size)
        cut = np.partition(score, size - k, axis=1)[:, size - k] if k < size else score.min(axis=1)
        cut = np.maximum(np.maximum(cut, self.score[rows, -1]), NONE + 1)
        r, c = np.nonzero(score >= cut[:, None])
        order = np.lexsort((c, -score[r, c], r))
        r, c = r[order], c[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        r, c, rank = r[rank < k], c[rank < k], rank[rank < k]
        if not len(r):
            return
        s, i, w = np.full((len(rows), 2 * self.k), NONE), np.zeros((len(rows), 2 * self.k), np.int64), np.zeros((len(rows), 2 * self.k), np.int64)
        for new, old in ((s, self.score), (i, self.id), (w, self.row)):
            new[:, : self.k] = old[rows]
        s[r, self.k + rank], i[r, self.k + rank], w[r, self.k + rank] = score[r, c], block.ids[c], block.rows[c]
        order = np.lexsort((w, i, -s), axis=-1)[:, : self.k]
        for new, old in ((s, self.score), (i, self.id), (w, self.row)):
            old[rows] = np.take_along_axis(new, order, axis=1)


def met(pairs: DataFrame, asking: DataFrame, held: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """Rows with the vectors of both blocks of each pair (a, c): columns a_..., c_..., rows of one asking block together.

    The pairs of one asking block are dealt to several tasks, so that few blocks still use the cluster. ``more``: further
    columns by a.
    """
    spark = pairs.sparkSession
    data = ["n", "center", "radius", "ids", "at", "labels", "mat"]
    take = lambda df, p: df.select(F.col("block").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in data])
    shares = max(1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, asking.count()))
    asked = take(asking, "a")
    if more is not None:
        asked = asked.join(more, "a")
    asked = asked.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    dealt = pairs.select("a", "c", F.pmod(F.xxhash64("c"), F.lit(shares)).cast("int").alias("share"))
    return dealt.join(take(held, "c").hint("merge"), "c").join(asked.hint("merge"), ["a", "share"])


def solve(
    rows: DataFrame, table: Table, schema: str, begin: Callable, step: Callable, result: Callable
) -> DataFrame:
    """``begin(asking block, batch, i)`` makes the state of a block, ``step(state, block)`` takes a held block in, and
    ``result(state)`` gives a batch. States are one at a time; a block that comes back has a new one."""
    width, kind = table.width, table.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            a = b.column("a").to_numpy()
            for i in range(b.num_rows):
                if now != a[i]:
                    if now is not None:
                        yield result(state)
                    now, state = a[i], begin(Block(width, kind, b, i, "a"), b, i)
                step(state, Block(width, kind, b, i, "c"))
        if now is not None:
            yield result(state)

    return rows.mapInArrow(run, schema)
