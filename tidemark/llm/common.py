"""Shared plumbing of the corpus operators: scratch tables, text batches, word tables, hashes.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D; every operator that
hashes words does so here, vectorised over the UTF-8 buffer of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import discard, free, scratch_path, shared_dir, stored

__all__ = ["discard", "free", "scratch_path", "shared_dir", "stored"]

#: Bytes of text that one vectorised step holds; a longer text is one step of its own.
STEP_BYTES = 2_000_000


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, each as often as it is read, whatever joins make of them; one whose size is
    not known counts 0."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(s for s in sizes if s < 1 << 60)


def shards_for(df: DataFrame, bytes_each: int = 48 << 20) -> int:
    """Number of hash shards that grows with the input, at least the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, input_bytes(df) // bytes_each)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names; a null text is empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )


def steps(batches: Iterator[pa.RecordBatch], most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text; never empty ones."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        lo = 0
        while lo < b.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + most, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def buffer_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without nulls, and the rows' offsets in them, from 0."""
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offs, data = col.buffers()
    if offs is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(offs, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0] : o[-1]], o - o[0]


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads them."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    exact = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    lower = exact.copy()
    lower[65:91] = exact[97:123]
    return exact, lower


_EXACT, _LOWER = _byte_tables()
_R = np.uint64(0x9E3779B97F4A7C15)
_RI = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, STEP_BYTES + 200_000)
        for name, base in (("up", _R), ("down", _RI)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
        if size > 4 * STEP_BYTES:  # one huge text must not stay in memory
            got = _POWERS["up"], _POWERS["down"]
            _POWERS.clear()
            return got[0][:n], got[1][:n]
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Words:
    """The words of some texts: ``start``/``end`` byte positions, ``first[i]:first[i+1]`` the words of text i."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs = data, offs
        n = len(data)
        inside = ~_IS_SPACE[data]
        opens = inside.copy()
        if n:
            opens[1:] &= ~inside[:-1]
            cut = offs[:-1][(offs[:-1] < n) & (offs[1:] > offs[:-1])]
            opens[cut] |= inside[cut]
            closes = inside.copy()
            closes[:-1] &= ~inside[1:]
            last = offs[1:][offs[1:] > offs[:-1]] - 1
            closes[last] |= inside[last]
            self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, offs)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hash of each word; with ``lower``, A-Z count as a-z."""
        return range_hashes(self.data, self.start, self.end, lower)


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each range of bytes, in ascending order and apart. Works through the bytes in steps."""
    table, n = (_LOWER if lower else _EXACT), len(start)
    out, i = np.zeros(n, np.uint64), 0
    while i < n:
        a = int(start[i])
        j = max(i + 1, int(np.searchsorted(end, a + STEP_BYTES, "right")))
        b = int(end[j - 1])
        up, down = _powers(b - a)
        run = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[data[a:b]] * up, out=run[1:])
        lo, hi = start[i:j] - a, end[i:j] - a
        out[i:j] = mix((run[hi] - run[lo]) * down[lo] + (hi - lo).astype(np.uint64))
        i = j
    return out


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive hashes (those across two texts are the caller's to leave out)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[j : len(h) - n + 1 + j]
    return mix(out + np.uint64(n))


def within(first: np.ndarray, n: int) -> np.ndarray:
    """Which n-gram starts, of all words of a batch, lie whole in one text."""
    total = int(first[-1])
    ok = np.ones(max(0, total - n + 1), bool)
    for j in range(1, n):
        cut = first[1:-1] - j
        cut = cut[(cut >= 0) & (cut < len(ok))]
        ok[cut] = False
    return ok


def ragged(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices lo[i] .. lo[i]+size[i]-1, one row after the other."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(size) - size
    return np.arange(total, dtype=np.int64) + np.repeat(lo - at, size)
