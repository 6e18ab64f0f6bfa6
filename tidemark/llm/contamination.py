"""Operator 6: benchmark passages in documents, by the q-gram lemma and banded alignment.

A benchmark text is cut into overlapping segments. A segment of L characters that occurs with at most k edits shares at
least L - q + 1 - k * q of its q-grams with that place, on at most k + 1 neighbouring diagonals (place in the document
minus place in the segment). So q-gram hits are counted in diagonal bands of 2 * (k + 1) that overlap by half; bands
with enough hits are verified by an alignment restricted to the band. Texts are compared in lower case with white space
collapsed.

Which document shares enough with which segment is first told by q-grams that are rare among the segments: of a segment with
c common ones, all but c of the asked-for hits are rare. So a template that all items begin with makes no pairs. A segment
that would be left without rare hits keeps its common ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

Q = 10
#: Edits allowed for each character of a segment; segment length and step; benchmark texts under LEAST are searched as they are.
EDIT_SHARE, SEGMENT, STEP, LEAST = 0.08, 120, 60, 40
#: Characters of benchmark text that one pass over the documents holds; more are taken in further passes.
BLOCK_CHARS = 2_000_000
#: Hits (a q-gram's place in a document with one in a segment) that one step holds.
STEP_HITS = 2_000_000
#: A q-gram at more places of the segments is common: templates of items have such.
COMMON = 64
_R = 0x9E3779B97F4A7C15
HITS = "doc_id long, item_id long, n_segments long, edits long, begin long, end long"
_SLOTS = 1 << 22


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgrams(c: np.ndarray) -> np.ndarray:
    """Hash of each Q consecutive characters, by doubling."""
    if len(c) < Q:
        return np.zeros(0, np.uint64)
    p = lambda n: np.uint64(pow(_R, n, 1 << 64))
    h1 = c.astype(np.uint64)
    h2 = h1[:-1] * p(1) + h1[1:]
    h4 = h2[:-2] * p(2) + h2[2:]
    h8 = h4[:-4] * p(4) + h4[4:]
    h = h8[: len(c) - Q + 1] * p(2) + h2[8:]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


@dataclass
class Index:
    """Segments of one block of benchmark texts, and where each q-gram stands in them."""

    item: np.ndarray
    length: np.ndarray
    edits: np.ndarray
    need: np.ndarray
    text: list[np.ndarray]
    grams: np.ndarray
    first: np.ndarray
    seg: np.ndarray
    pos: np.ndarray
    #: The same for the entries that tell pairs, and the hits that a pair needs of them.
    rare_first: np.ndarray
    rare_seg: np.ndarray
    rare_need: np.ndarray


def build(items: list[tuple[int, str]]) -> Index | None:
    item, text = [], []
    for i, raw in items:
        c = codes(normal(raw))
        if len(c) < LEAST:
            continue
        starts = [0] if len(c) <= SEGMENT + STEP else [*range(0, len(c) - SEGMENT, STEP), len(c) - SEGMENT]
        size = len(c) if len(starts) == 1 else SEGMENT
        item += [i] * len(starts)
        text += [c[s : s + size] for s in starts]
    if not text:
        return None
    length = np.array([len(c) for c in text])
    edits = (length * EDIT_SHARE).astype(np.int64)
    g = [qgrams(c) for c in text]
    h = np.concatenate(g)
    seg, pos = np.repeat(np.arange(len(text)), [len(x) for x in g]), np.concatenate([np.arange(len(x)) for x in g])
    order = np.argsort(h, kind="stable")
    grams, first = np.unique(h[order], return_index=True)
    first, seg, pos = np.append(first, len(h)), seg[order], pos[order]
    need = length - Q + 1 - edits * Q
    size = np.diff(first)
    often = np.repeat(size > COMMON, size)
    many = np.bincount(seg[often], minlength=len(text))
    kept = ~often | (many >= need)[seg]
    rare_first = np.append(0, np.cumsum(kept))[first]
    return Index(np.array(item), length, edits, need, text, grams, first, seg, pos, rare_first, seg[kept], np.where(many < need, need - many, need))


def _add(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of all parts ascending, and their counts together."""
    every, at = np.unique(np.concatenate([np.zeros(0, np.int64), *codes]), return_inverse=True)
    total = np.bincount(at, np.concatenate([np.zeros(0, np.int64), *counts]), len(every)) if len(every) else np.zeros(0)
    return every, total.astype(np.int64)


def candidates(ix: Index, h: np.ndarray, doc: np.ndarray, first: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Rows (doc, segment, band) whose band has the hits that the lemma asks for. h: q-gram hashes of all texts in a row.

    Pairs of a document and a segment are counted and thinned in steps of whole documents of about ``STEP_HITS`` hits; a
    document with more is a step of its own, which holds a count for each segment at most and its hits by parts.
    """
    hit = np.flatnonzero(slots[h >> np.uint64(42)])
    at = np.searchsorted(ix.grams, h[hit])
    at[at == len(ix.grams)] = 0
    ok = ix.grams[at] == h[hit]
    hit, at, n = hit[ok], at[ok], len(ix.item)

    def steps(hit: np.ndarray, size: np.ndarray) -> Iterator[list[slice]]:
        """Parts of each step of whole documents."""
        ends, own, lo = np.cumsum(size), doc[hit], 0
        cuts = np.append(np.flatnonzero(own[1:] != own[:-1]) + 1, len(own)) if len(own) else np.zeros(0, np.int64)
        while lo < len(hit):
            base = ends[lo - 1] if lo else 0
            fit = np.searchsorted(cuts, np.searchsorted(ends, base + STEP_HITS, "right"), "right") - 1
            hi = int(cuts[max(fit, int(np.searchsorted(cuts, lo, "right")))])
            parts, i = [], lo
            while i < hi:
                j = max(i + 1, min(hi, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + STEP_HITS, "right"))))
                parts.append(slice(i, j))
                i = j
            yield parts
            lo = hi

    found = []
    size = ix.rare_first[at + 1] - ix.rare_first[at]
    for parts in steps(hit, size):
        counted = [np.unique(np.repeat(doc[hit[x]], size[x]) * n + ix.rare_seg[common.ragged(ix.rare_first[at[x]], size[x])], return_counts=True) for x in parts]
        pair, count = _add(*zip(*counted, strict=True))
        found.append(pair[count >= ix.rare_need[pair % n]])
    pair = np.concatenate([np.zeros(0, np.int64), *found])
    if not len(pair):
        return np.zeros((0, 3), np.int64)
    ok = np.isin(doc[hit], pair // n)
    hit, at, out = hit[ok], at[ok], []
    size = ix.first[at + 1] - ix.first[at]
    for parts in steps(hit, size):
        codes, counts = [], []
        for x in parts:
            entry, place = common.ragged(ix.first[at[x]], size[x]), np.repeat(hit[x], size[x])
            code = doc[place] * n + ix.seg[entry]
            k = np.searchsorted(pair, code)
            keep = k < len(pair)
            keep[keep] = pair[k[keep]] == code[keep]
            k, place, entry = k[keep], place[keep], entry[keep]
            band = (place - first[doc[place]] - ix.pos[entry]) // (ix.edits[ix.seg[entry]] + 1)
            code = (k << 32) + band + (1 << 31)  # a text has less than 2^31 characters
            code, count = np.unique(np.concatenate([code, code - 1]), return_counts=True)
            codes.append(code)
            counts.append(count)
        code, count = _add(codes, counts)
        own = pair[code >> 32]
        rows = np.stack([own // n, own % n, (code & 0xFFFFFFFF) - (1 << 31)], 1)
        out.append(rows[count >= ix.need[rows[:, 1]]])
    return np.concatenate(out)


def align(segment: np.ndarray, area: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each segment (row) with a stretch of its area, and that stretch's end.

    area[r, i + j] is the character opposite segment[r, i] on the band's j-th diagonal.
    """
    n, length = segment.shape
    width = area.shape[1] - length
    cost = np.zeros((n, width), np.int32)
    ramp = np.arange(width, dtype=np.int32)
    for i in range(length):
        step = cost + (area[:, i : i + width] != segment[:, i : i + 1])
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(step - ramp, axis=1) + ramp
    j = cost.argmin(axis=1)
    return cost[np.arange(n), j], j + length


def _find_short(items: list[tuple[int, str]]):
    """Whole short items between the words of a text, without edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        known = ahocorasick.Automaton()
        for i, t in items:
            known.add_word(f" {t} ", (*known.get(f" {t} ", ()), i, len(t)))
        known.make_automaton()
        for b in batches:
            rows = []
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                seen = {}
                for end, names in known.iter(f" {normal(t)} "):
                    for i, size in zip(names[::2], names[1::2], strict=True):
                        seen.setdefault(i, (end - 1 - size, end - 1))
                rows += [(d, i, 1, 0, *seen[i]) for i in sorted(seen)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "item_id", "n_segments", "edits", "begin", "end"])

    return run


def _find(ix: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(_SLOTS, bool)
        slots[ix.grams >> np.uint64(42)] = True
        for b in common.steps(batches, 1_000_000):
            got = [codes(normal(t)) for t in b.column("text").to_pylist()]
            size = np.array([len(c) + 1 for c in got])
            first = np.cumsum(size) - size
            flat = np.concatenate([x for c in got for x in (c, _GAP)])
            h = qgrams(flat)
            doc = np.repeat(np.arange(len(got)), size)[: len(h)]
            rows = candidates(ix, h, doc, first, slots)
            best: dict[tuple[int, int], list] = {}
            for length in np.unique(ix.length[rows[:, 1]]).tolist():
                group = rows[ix.length[rows[:, 1]] == length]
                k = int(ix.edits[group[0, 1]])
                for lo in range(0, len(group), 2048):
                    part = group[lo : lo + 2048]
                    seg = np.stack([ix.text[s] for s in part[:, 1]])
                    start = part[:, 2] * (k + 1)
                    where = start[:, None] + np.arange(length + 2 * (k + 1))
                    inside = (where >= 0) & (where < size[part[:, 0], None] - 1)
                    area = np.where(inside, flat[np.where(inside, where + first[part[:, 0], None], 0)], _GAP[0])
                    edits, end = align(seg, area)
                    for (d, s, _), e, z in zip(part[edits <= k].tolist(), edits[edits <= k].tolist(), (start + end)[edits <= k].tolist(), strict=True):
                        row = best.setdefault((d, int(ix.item[s])), [set(), e, z - length, z])
                        row[0].add(s)
                        if e < row[1]:
                            row[1:] = [e, z - length, z]
            keys = sorted(best)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").take(pa.array([d for d, _ in keys], pa.int64())),
                        pa.array([i for _, i in keys], pa.int64()),
                        pa.array([len(best[k][0]) for k in keys], pa.int64()),
                        *(pa.array([max(0, best[k][j]) for k in keys], pa.int64()) for j in (1, 2, 3)),
                    ],
                    ["doc_id", "item_id", "n_segments", "edits", "begin", "end"],
                )

    return run


_GAP = np.array([0x110000], np.uint32)


def blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's rows in lists of at most BLOCK_CHARS characters (or one longer text)."""
    part, chars = [], 0
    rows = benchmark.select(F.col(item_col).cast("long"), F.col(text_col).cast("string")).where(f"`{item_col}` is not null and `{text_col}` is not null")
    for i, t in rows.distinct().toLocalIterator():
        if part and chars + len(t) > BLOCK_CHARS:
            yield part
            part, chars = [], 0
        part.append((i, t))
        chars += len(t)
    if part:
        yield part


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    short: bool = True,
) -> DataFrame:
    """A row for each document and benchmark item of which it holds a passage.

    doc_id, item_id, n_segments (of the item's segments), edits (of the best), begin and end of the best (code points of
    the normalised text). A passage counts from one whole segment: 120 characters at steps of 60, so that every passage
    of 179 characters holds one; an item of up to 180 characters counts as a whole. An item under 40
    characters counts where its words stand as they are, without edits; ``short=False`` leaves these out, as an answer like
    "yes" is no evidence. Null or empty texts and items have no rows, nor have rows with a null item_id; texts may be of any
    length. Repeated documents each have theirs; repeated items
    count once. Other columns are not read. Empty tables: no rows.
    """
    spark = docs.sparkSession
    rows = common.texts(docs, id_col, text_col)
    out = spark.createDataFrame([], HITS)
    for part in blocks(benchmark, item_col, item_text_col):
        ix = build(part)
        if ix is not None:
            out = out.unionByName(rows.mapInArrow(_find(ix), HITS))
        few = sorted({(i, n) for i, t in part if 0 < len(n := normal(t)) < LEAST}) if short else []
        if few:
            out = out.unionByName(rows.mapInArrow(_find_short(few), HITS))
    return out


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
