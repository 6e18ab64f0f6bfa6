"""Operator 5: repeated passages, found by matching statistics on a compressed index of each shard.

Every window of ``width`` words has an anchor: the least hash of its ``GRAM``-word runs, which depends on its words
alone. Neighbouring windows with one anchor form a segment. Segments whose anchor occurs only once in the corpus hold no
repeated window and go no further. The others meet in the shard of their anchor's hash. A shard indexes its distinct
segments: suffix array, Burrows-Wheeler transform, and a wavelet matrix of bit vectors with ranks. Segments are then
streamed backwards through the index; the longest suffix that still occurs twice ends at each place (its matching
statistic), and stretches of at least ``width`` words are reported. Equal segments are indexed once; for one that occurs
more than once in the corpus, a single place in the index is enough.

An anchor with very many segments would make one shard large; its segments are cut into single windows, which go to the
shards of their own hashes, where equal ones meet just as well.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import common
from tidemark.llm.exchange import MESSAGE, each_row, pack, pieces, rows_of, small, trim, unpack, with_answers

WIDTH, GRAM = 35, 8
#: Segments of one anchor that a shard takes whole.
HOT = 20_000
#: Bytes of text of a block, and of input files for each shard.
BLOCK_BYTES, SHARD_BYTES = 6_000_000, 4 << 20
BLOCK = "block long, payload binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, made, size = TaskContext.get().partitionId(), 0, 0
    ids, texts = [], []

    def block() -> pa.RecordBatch:
        nonlocal made, size
        raw = b"".join(texts)
        body = pickle.dumps((ids[:], np.array([len(t) for t in texts], np.int64), len(raw), pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)))
        made, size = made + 1, 0
        ids.clear()
        texts.clear()
        return rows_of([((part << 24) | made, body)], BLOCK)

    for b in common.steps(batches):
        got = [t.encode() for t in b.column("text").to_pylist()]
        ids += b.column("doc_id").to_pylist()
        texts += got
        size += sum(map(len, got))
        if size >= BLOCK_BYTES:
            yield block()
    if ids:
        yield block()


def sliding_min(v: np.ndarray, n: int) -> np.ndarray:
    """Least of each n neighbours."""
    out, have = v, 1
    while 2 * have <= n:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (n - have)], out[n - have :]) if n > have else out


class Segments:
    """Words and anchored segments of a block."""

    def __init__(self, payload: bytes, width: int):
        self.ids, sizes, raw_size, raw = pickle.loads(payload)
        self.raw = pa.Codec("zstd").decompress(raw, raw_size, asbytes=True) if raw_size else b""
        self.offs = np.concatenate([[0], np.cumsum(sizes)])
        self.words = common.Words(np.frombuffer(self.raw, np.uint8), self.offs)
        h = self.words.hashes()
        self.hash, n = h, len(h)
        self.start = self.count = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, np.uint64)
        if n >= width:
            g = common.grams(h, GRAM)
            least = sliding_min(g, width - GRAM + 1)
            v = np.flatnonzero(common.within(self.words.first, width))
            if len(v):
                val = least[v]
                new = np.ones(len(v), bool)
                new[1:] = (np.diff(v) != 1) | (val[1:] != val[:-1])
                at = np.flatnonzero(new)
                self.start, lowest = v[at], val[at]
                self.anchor = common.mix(lowest)  # least hashes are all small; shards go by ranges
                self.count = np.diff(np.append(at, len(v)))
                size = self.count + width - GRAM
                seg = np.repeat(np.arange(len(at)), size)
                same = g[common.ragged(self.start, size)] == lowest[seg]
                self.weight = np.bincount(seg[same], minlength=len(at))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors ascending, their occurrences, and each segment's place among them."""
        if not len(self.start):
            return self.anchor, np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, at = np.unique(self.anchor, return_inverse=True)
        return a, np.bincount(at, self.weight, len(a)).astype(np.int64), at

    def items(self, kind: np.ndarray, shards: int, width: int) -> tuple[np.ndarray, ...]:
        """What is sent: per distinct item its first place, words, copies (at most 2), and the shards' slices of them; then each item's place
        among the distinct ones with the word it starts at. kind: per segment 0 unique anchor, 1 whole, 2 as windows."""
        whole, cut = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
        start = np.concatenate([self.start[whole], common.ragged(self.start[cut], self.count[cut])])
        size = np.concatenate([self.count[whole] + width - 1, np.full(int(self.count[cut].sum()), width)])
        up, down = common._powers(len(self.hash) + 1)
        run = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(self.hash * up[:-1], out=run[1:])
        content = common.mix((run[start + size] - run[start]) * down[start] + size.astype(np.uint64))
        key = np.concatenate([self.anchor[whole], common.mix(content[len(whole) :])])
        order = np.lexsort((content, key))
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(content[order]) != 0) | (np.diff(key[order]) != 0)
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(first) - 1
        lead = order[first]
        copies = np.minimum(2, np.bincount(place, minlength=len(lead)))
        return start[lead], size[lead], copies, pieces(key[lead], shards), place, start, size


def _ask_anchors(shards: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each_row(batches):
            a, n, _ = Segments(r["payload"], width).anchors()
            for s, x in pieces(a, shards).items():
                yield rows_of([("anchor", s, r["block"], pack(a[x], small(n[x])))], MESSAGE)

    return run


def _count_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For each anchor of each block: 0 if it occurs once in the corpus, 1 if more often, 2 if too often for one shard."""
    got = [(b, *unpack(p)) for b, p in sorted(zip(table["block"].to_pylist(), table["payload"].to_pylist(), strict=True))]
    names, at = np.unique(np.concatenate([g[1] for g in got]), return_inverse=True)
    total = np.bincount(at, np.concatenate([g[2] for g in got]), len(names))
    kind = ((total > 1).astype(np.uint8) + (total > HOT)).astype(np.uint8)
    where = np.cumsum([0, *(len(g[1]) for g in got)])
    rows = [("anchor", key[0].as_py(), b, pack(kind[at[where[i] : where[i + 1]]])) for i, (b, *_) in enumerate(got)]
    return pa.Table.from_batches([rows_of(rows, MESSAGE)])


def _kinds(seg: Segments, answers: list[dict], shards: int) -> np.ndarray:
    a, _, at = seg.anchors()
    cut, kind = pieces(a, shards), np.zeros(len(a), np.uint8)
    for r in answers:
        if r["kind"] == "anchor":
            kind[cut[r["shard"]]] = unpack(r["payload"])[0]
    return kind[at]


def _send_segments(shards: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for r in each_row(batches):
            seg = Segments(r["payload"], width)
            start, size, copies, cut, *_ = seg.items(_kinds(seg, r["answers"] or [], shards), shards, width)
            w = seg.words
            for s, x in cut.items():
                lo, hi = w.start[start[x]], w.end[start[x] + size[x] - 1]
                raw = w.data[common.ragged(lo, hi - lo)].tobytes()
                body = pickle.dumps((pack(small(hi - lo), copies[x].astype(np.uint8)), len(raw), codec.compress(raw, asbytes=True)))
                yield rows_of([("segment", s, r["block"], body)], MESSAGE)
            del seg, w
            trim()

    return run


# The index of a shard ----------------------------------------------------------------------------------------------


def suffix_array(t: np.ndarray) -> np.ndarray:
    """By prefix doubling; ``t`` ends with its least symbol, which is nowhere else."""
    rank, k = np.unique(t, return_inverse=True)[1].astype(np.int64), 1
    n = len(t)
    while True:
        key = rank * (n + 1)
        key[: n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(np.diff(key[order]) != 0)
        rank, k = new, 2 * k
        if rank[order[-1]] == n - 1 or k >= n:
            return order


class FMIndex:
    """Backward search over a wavelet matrix of the Burrows-Wheeler transform. Symbols are 0 .. sigma - 1."""

    def __init__(self, t: np.ndarray, sigma: int):
        sa = suffix_array(t)
        seq = t[sa - 1]
        self.n = len(t)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=sigma))])
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = ((seq >> level) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.pad(packed, (0, 8 - len(packed) % 8 + 8)).view(np.uint64) if len(packed) % 8 else np.pad(packed, (0, 8)).view(np.uint64)
            self.bits.append(packed)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed[:-1]).astype(np.int32))]).astype(np.int32))
            self.zeros.append(int((~bit).sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])
        self.below = self.below.astype(np.int32)
        self.base = self._descend(np.arange(sigma, dtype=np.int32), np.zeros(sigma, np.int32))

    def _rank(self, i: int, p: np.ndarray) -> np.ndarray:
        word, shift = p >> 6, (p & 63).astype(np.uint64)
        mask = (np.uint64(1) << shift) - np.uint64(1)
        return self.ones[i][word] + np.bitwise_count(self.bits[i][word] & mask).astype(np.int32)

    def _descend(self, c: np.ndarray, p: np.ndarray) -> np.ndarray:
        for i in range(self.levels):
            r = self._rank(i, p)
            p = np.where((c >> (self.levels - 1 - i)) & 1, r + np.int32(self.zeros[i]), p - r)
        return p

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of c + pattern, from that of pattern."""
        both = self._descend(np.concatenate([c, c]), np.concatenate([lo, hi])) + np.tile(self.below[c] - self.base[c], 2)
        return both[: len(c)], both[len(c) :]


def repeated_windows(fm: FMIndex, text: np.ndarray, first: np.ndarray, size: np.ndarray, need: np.ndarray, width: int) -> np.ndarray:
    """Which windows of segments ``text[first:first+size]`` have ``need`` places in the index; in a row, by segment."""
    windows = size - width + 1
    out = np.cumsum(windows) - windows
    gain = np.zeros(int(windows.sum()) + 1, np.int64)
    end = size.copy()
    live = np.arange(len(size))
    while len(live):
        at = end[live].copy()
        lo, hi = np.zeros(len(live), np.int32), np.full(len(live), fm.n, np.int32)
        go = np.arange(len(live))
        while len(go):
            lo2, hi2 = fm.extend(text[first[live[go]] + at[go] - 1], lo[go], hi[go])
            ok = hi2 - lo2 >= need[live[go]]
            go = go[ok]
            lo[go], hi[go] = lo2[ok], hi2[ok]
            at[go] -= 1
            go = go[at[go] > 0]
        long = end[live] - at >= width
        np.add.at(gain, out[live[long]] + at[long], 1)
        np.add.at(gain, out[live[long]] + end[live[long]] - width + 1, -1)
        end[live] = np.where(long, np.where(at == 0, 0, at + width - 1), end[live] - 1)
        live = live[end[live] >= width]
    return np.cumsum(gain[:-1]) > 0


def _match(width: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        got, codec = [], pa.Codec("zstd")
        for b, p in sorted(zip(table["block"].to_pylist(), table["payload"].to_pylist(), strict=True)):
            sizes, raw_size, raw = pickle.loads(p)
            got.append((b, *unpack(sizes), codec.decompress(raw, raw_size, asbytes=True)))
        data = np.frombuffer(b"".join(g[3] for g in got), np.uint8)
        offs = np.concatenate([[0], np.cumsum(np.concatenate([g[1].astype(np.int64) for g in got]))])
        parts = [w := common.Words(data, offs)]
        h, first, size = w.hashes(), w.first[:-1], np.diff(w.first)
        symbols, text = np.unique(h, return_inverse=True)
        del parts, h
        # distinct items of all blocks, with their copies
        up, down = common._powers(len(text) + 1)
        run_sum = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(common.mix(symbols)[text] * up[:-1], out=run_sum[1:])
        content = common.mix((run_sum[first + size] - run_sum[first]) * down[first] + size.astype(np.uint64))
        _, lead, place = np.unique(content, return_index=True, return_inverse=True)
        copies = np.minimum(2, np.bincount(place, np.concatenate([g[2] for g in got]), len(lead))).astype(np.int64)
        # the text of the index: 0 ends it, 1 stands between items
        gap = np.cumsum(size[lead] + 1) - 1
        body = np.ones(int((size[lead] + 1).sum()) + 1, np.int32)
        body[-1] = 0
        filled = np.ones(len(body) - 1, bool)
        filled[gap] = False
        text = text.astype(np.int32) + 2
        body[:-1][filled] = text[common.ragged(first[lead], size[lead])]
        fm = FMIndex(body, len(symbols) + 2)
        flags = repeated_windows(fm, text, first[lead], size[lead], np.where(copies > 1, 1, 2), width)
        windows = size[lead] - width + 1
        begin = np.cumsum(windows) - windows
        rows, at = [], 0
        for b, sizes, *_ in got:
            mine = place[at : at + len(sizes)]
            at += len(sizes)
            rows.append(("segment", key[0].as_py(), b, np.packbits(flags[common.ragged(begin[mine], windows[mine])]).tobytes()))
        del fm, body, text, data, got
        trim()
        return pa.Table.from_batches([rows_of(rows, MESSAGE)])

    return run


def _remove(shards: int, width: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each_row(batches):
            seg = Segments(r["payload"], width)
            answers = r["answers"] or []
            start, size, _, cut, place, starts, sizes = seg.items(_kinds(seg, answers, shards), shards, width)
            windows = size - width + 1
            begin = np.concatenate([[0], np.cumsum(windows)])
            flags = np.zeros(int(begin[-1]), bool)
            for a in answers:
                if a["kind"] == "segment":
                    x = cut[a["shard"]]
                    lo, hi = begin[x.start], begin[x.stop]
                    flags[lo:hi] = np.unpackbits(np.frombuffer(a["payload"], np.uint8), count=hi - lo)
            n = sizes - width + 1
            hit = common.ragged(starts, n)[flags[common.ragged(begin[place], n)]]
            depth = np.zeros(len(seg.hash) + 1, np.int64)
            np.add.at(depth, hit, 1)
            np.add.at(depth, hit + width, -1)
            gone = np.cumsum(depth[:-1]) > 0
            out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept_text")}
            first = seg.words.first
            for i in range(len(seg.ids)):
                words, mask = seg.raw[seg.offs[i] : seg.offs[i + 1]].split(), gone[first[i] : first[i + 1]]
                lost = int(mask.sum())
                kept = b" ".join(compress(words, (~mask).tolist()) if lost else words)
                for k, v in (("n_words", len(words)), ("n_removed", lost), ("kept_sha256", hashlib.sha256(kept).hexdigest())):
                    out[k].append(v)
                if with_text:
                    out["kept_text"].append(kept.decode())
            cols = [pa.array(seg.ids, pa.int64()), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept_sha256"], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols, names = [*cols, pa.array(out["kept_text"], pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(cols, names)
            del seg, cols, out
            trim()

    return run


def remove_repeats(docs: DataFrame, *, width: int = WIDTH, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text): each document without its repeated passages.

    A word goes if a window of ``width`` words over it also starts anywhere else, in this document or another. Kept
    words are joined by one space. Null or empty text: no words. Rows with one id, or a null one, are documents of their
    own; so a row that is repeated loses all words, if it has ``width`` of them. Empty table: no rows. Other columns are
    not read. ``width`` is at least GRAM.
    """
    spark = docs.sparkSession
    shards = common.shards_for(docs, SHARD_BYTES)
    blocks = common.stored(common.texts(docs, id_col, text_col).mapInArrow(_blocks, BLOCK), "blocks")
    anchors = common.stored(blocks.mapInArrow(_ask_anchors(shards, width), MESSAGE).groupBy("shard").applyInArrow(_count_anchors, MESSAGE), "anchors")
    common.free(spark)
    sent = with_answers(blocks, anchors).mapInArrow(_send_segments(shards, width), MESSAGE)
    found = common.stored(sent.groupBy("shard").applyInArrow(_match(width), MESSAGE), "matches")
    common.free(spark)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return with_answers(blocks, anchors.unionByName(found)).mapInArrow(_remove(shards, width, with_text), schema)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
