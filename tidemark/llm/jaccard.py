"""Operator 1: Jaccard join of word-shingle sets by PartEnum signatures.

Two sets of sizes a <= b with Jaccard similarity >= t differ in at most D = (1 - t) / (1 + t) * (a + b) elements. Sizes fall
in bands such that similar sets are in the same or neighbouring bands; a set signs for its own band and the next. For a
band whose largest pair may differ in k elements, the hashed domain is cut into n1 = ceil((k + 1) / 2) first-level
partitions: in one of them two similar sets differ at most once. Each is cut into three, and each two of the three give
a signature, the hash of the set's elements there: the two that the difference missed agree. So similar sets share a
signature, whatever the data; sets that don't are never compared.

Sets that share a signature form a bucket. Buckets never become all their pairs. Parity sketches, whose differing bits never
exceed the differing elements, are compared inside a bucket, in stripes of bounded size; a spanning forest of the pairs
that they leave possible gives clusters, outside which no link can be. The sets of a cluster are then compared in full,
again in stripes, passing over pairs that links already connect; a spanning forest of the links gives the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.operators.graph import components
from tidemark.llm.exchange import MESSAGE, pack, pieces, rows_of, small, unpack

#: Bytes of text whose signatures a block gathers, bytes of input files for each shard; members of a stripe of sketches, and
#: of whole sets.
BLOCK_BYTES, SHARD_BYTES, STRIPE, SET_STRIPE = 12_000_000, 16 << 20, 1024, 256
SETS = "doc_id long, node long, n_shingles long, sketch binary"
#: Documents to verify that each task is told of; more are found by a join on their ids.
TOLD = 1_000_000
BUCKETS = "bucket long, node long, members long"


class Sets:
    """Distinct shingles of each text: ``values[first[i]:first[i+1]]`` ascending; ``node`` is a hash of the whole set."""

    def __init__(self, col: pa.Array, n: int):
        w = common.Words(*common.buffer_of(col))
        h, count = w.hashes(lower=True), np.diff(w.first)
        g = common.grams(h, n)
        short = {k: common.grams(h, k) for k in range(1, n) if (count == k).any()}
        parts = []
        for lo, c in zip(w.first[:-1].tolist(), count.tolist(), strict=True):
            if c >= n:
                s = np.sort(g[lo : lo + c - n + 1])
                parts.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            else:
                parts.append(short[c][lo : lo + 1] if c else g[:0])
        self.size = np.array([len(p) for p in parts], np.int64)
        self.values = np.concatenate(parts) if parts else g[:0]
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        total = np.zeros(len(parts), np.uint64)
        np.add.at(total, np.repeat(np.arange(len(parts)), self.size), common.mix(self.values))
        self.node = (common.mix(total + self.size.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.steps(batches):
            s = Sets(b.column("text"), n)
            node = pa.array(s.node, mask=s.size == 0)
            new = np.zeros(len(s.node), bool)  # copies in a step need one sketch
            new[np.unique(s.node, return_index=True)[1]] = True
            each = [sketch(s.values[i:j]) if n else None for i, j, n in zip(s.first[:-1].tolist(), s.first[1:].tolist(), new.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), node, pa.array(s.size), pa.array(each, pa.binary())], ["doc_id", "node", "n_shingles", "sketch"])

    return run


def bands(percent: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Least size of each band up to ``top``, and the differing elements that two sets of it may have."""
    low, diff, at = [], [], 1
    while at <= top or len(low) < 2:
        high = 100 * at // percent
        low.append(at)
        diff.append((100 - percent) * 2 * high // (100 + percent))
        at = high + 1
    high = 100 * at // percent
    return np.array([*low, at]), np.array([*diff, (100 - percent) * 2 * high // (100 + percent)])


def signatures(s: Sets, keep: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the sets ``keep``, and the set of each."""
    low, diff = bands(percent, int(s.size[keep].max(initial=1)))
    size = s.size[keep]
    values = s.values[common.ragged(s.first[keep], size)]
    own = np.searchsorted(low, size, "right") - 1
    sigs, who = [], []
    for band in (own, own + 1):
        k = diff[band]
        parts, cells = (k + 2) // 2, np.where(k > 0, 3, 1)
        first = np.cumsum(parts * 3) - parts * 3
        each = lambda x: np.repeat(x, size)  # noqa: B023, E731
        h = common.mix(values + each(band.astype(np.uint64)) * np.uint64(0xA24BAED4963EE407))
        p = (h >> np.uint64(33)).astype(np.int64) % each(parts)
        c = (h & np.uint64(0xFFFFFFFF)).astype(np.int64) % each(cells)
        sums = np.zeros(int((parts * 3).sum()), np.uint64)
        np.add.at(sums, each(first) + 3 * p + c, common.mix(h + np.uint64(0x5851F42D4C957F2D)))
        sums = sums.reshape(-1, 3)
        node = np.repeat(np.arange(len(keep)), parts)
        place = np.arange(len(sums)) - np.repeat(first // 3, parts)
        tag = common.mix(np.repeat(band, parts).astype(np.uint64) << np.uint64(32) | place.astype(np.uint64))
        many = np.repeat(k > 0, parts)
        for i, (x, y) in enumerate(((0, 1), (0, 2), (1, 2))):
            use = many if i else np.ones(len(sums), bool)
            sigs.append(common.mix(tag + sums[:, x] * np.uint64(3) + common.mix(sums[:, y] + np.uint64(i)))[use])
            who.append(node[use])
    return np.concatenate(sigs), np.concatenate(who)


def _sign(n: int, percent: int, shards: int):
    """Messages: a shard's part of a block's signatures, with the nodes that they are of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[np.ndarray] = []
        sigs: list[np.ndarray] = []
        who: list[np.ndarray] = []
        size = made = 0

        def block() -> Iterator[pa.RecordBatch]:
            table, at = np.unique(np.concatenate(nodes), return_inverse=True)
            s, w = np.concatenate(sigs), at[np.concatenate(who)]
            order = np.lexsort((w, s))
            s, w = s[order], w[order]
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != s[:-1]) | (w[1:] != w[:-1])
            s, w = s[new], w[new]
            for i, x in pieces(s, shards).items():
                mine, local = np.unique(w[x], return_inverse=True)
                yield rows_of([("sig", i, 0, pack(s[x], small(local), table[mine].astype(np.uint64)))], MESSAGE)
            for x in (nodes, sigs, who):
                x.clear()

        for b in common.steps(batches):
            s = Sets(b.column("text"), n)
            keep = np.flatnonzero(s.size > 0)
            keep = keep[np.unique(s.node[keep], return_index=True)[1]]
            got, of = signatures(s, keep, percent)
            sigs.append(got)
            who.append(of + made)
            nodes.append(s.node[keep])
            made += len(keep)
            size += b.column("text").nbytes
            if size >= BLOCK_BYTES:
                yield from block()
                size = made = 0
        if made:
            yield from block()

    return run


def _buckets(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Members of each bucket of two or more sets; buckets of equal members are one."""
    got = [unpack(p) for p in table["payload"].to_pylist()]
    sig = np.concatenate([g[0] for g in got])
    node = np.concatenate([g[2][g[1]] for g in got])
    order = np.lexsort((common.mix(node), sig))
    sig, node = sig[order], node[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node = sig[new], node[new]
    start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    count = np.diff(np.append(start, len(sig)))
    start, count = start[count > 1], count[count > 1]
    if not len(start):
        return pa.table({"bucket": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "members": pa.array([], pa.int64())})
    total = np.add.reduceat(common.mix(node[common.ragged(start, count)] + np.uint64(0x2545F4914F6CDD1D)), np.cumsum(count) - count)
    total, lead = np.unique(common.mix(total + count.astype(np.uint64)), return_index=True)
    start, count = start[lead], count[lead]
    return pa.table(
        {
            "bucket": pa.array(np.repeat(total.view(np.int64), count)),
            "node": pa.array(node[common.ragged(start, count)].view(np.int64)),
            "members": pa.array(np.repeat(count, count)),
        }
    )


# Verification ------------------------------------------------------------------------------------------------------


def sketch(values: np.ndarray) -> bytes:
    """Parity of the elements in each of 2^b >= n cells (64 at least)."""
    bits = max(64, 1 << int(max(1, len(values)) - 1).bit_length())
    cell = (common.mix(values + np.uint64(0x9FB21C651E98DF25)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(cell, minlength=bits) & 1, bitorder="little").tobytes()


class Group:
    """Sets of one stripe pair by their sketches, and which are connected so far."""

    def __init__(self, t: pa.Table, percent: int):
        self.node, self.size, self.percent = t["node"].to_pylist(), t["n"].to_pylist(), percent
        self.stripe = t["stripe"].to_pylist()
        raw = t["sketch"].to_pylist()
        self.bits = [8 * len(x) for x in raw]
        self.cells = [{8 * len(x): int.from_bytes(x, "little")} for x in raw]
        self.parent = list(range(len(raw)))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def at(self, x: int, bits: int) -> int:
        """x's sketch at fewer cells."""
        own = self.cells[x]
        if bits not in own:
            wide = self.at(x, 2 * bits)
            own[bits] = (wide >> bits) ^ (wide & ((1 << bits) - 1))
        return own[bits]

    def may_link(self, x: int, y: int) -> bool:
        most = (100 - self.percent) * (self.size[x] + self.size[y]) // (100 + self.percent)
        if abs(self.size[x] - self.size[y]) > most:
            return False
        bits = min(self.bits[x], self.bits[y])
        return (self.at(x, bits) ^ self.at(y, bits)).bit_count() <= most

    def forest(self, i: int, j: int, links) -> pa.Table:
        """Pairs of stripes i and j for which ``links`` holds, but for those that earlier ones connect."""
        left, right = ([k for k, s in enumerate(self.stripe) if s == x] for x in (i, j))
        xs, ys = [], []
        for x in left:
            for y in right:
                if (i != j or self.node[x] < self.node[y]) and self.find(x) != self.find(y) and links(x, y):
                    self.parent[self.find(x)] = self.find(y)
                    xs.append(self.node[x])
                    ys.append(self.node[y])
        return pa.table({"u": pa.array(xs, pa.int64()), "v": pa.array(ys, pa.int64())})


def _profiles(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.steps(batches):
            s = Sets(b.column("text"), n)
            each = [s.values[i:j].tobytes() for i, j in zip(s.first[:-1].tolist(), s.first[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(s.node), pa.array(each, pa.binary())], ["node", "shingles"])

    return run


def _possible(percent: int):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        g = Group(t, percent)
        return g.forest(key[1].as_py(), key[2].as_py(), g.may_link)

    return run


def _certain(percent: int):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        g = Group(t, percent)
        sets = [np.frombuffer(x, np.uint64) for x in t["shingles"].to_pylist()]

        def links(x: int, y: int) -> bool:
            if not g.may_link(x, y):
                return False
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            return 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both)

        return g.forest(key[1].as_py(), key[2].as_py(), links)

    return run


def _stripes(rows: DataFrame, group: str, size: int):
    """``rows`` (with ``members``, their group's number) once for each pair of stripes that they belong to, grouped."""
    n = F.expr(f"(members - 1) div {size} + 1")
    x = rows.withColumn("stripe", F.pmod(F.xxhash64("node"), n)).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    x = x.withColumn("i", F.least("stripe", "other")).withColumn("j", F.greatest("stripe", "other"))
    return x.drop("other", "members").groupBy(group, "i", "j")


def near_duplicates(docs: DataFrame, *, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every document.

    Words are lower-cased (A-Z); a set is the distinct n-word shingles of the whole text, or the whole sequence where it
    has fewer words. Documents link when 100 * intersection >= percent * union; component_id is the least doc_id that
    links reach. Null texts and texts without words have empty sets and link with nothing. A row with a null id takes the
    component of equal texts that have an id; a text that only such rows have links with nothing (null). Equal rows are
    documents of one set. Empty table: no rows. Only the named columns are read.
    """
    spark = docs.sparkSession
    rows, shards = common.texts(docs, id_col, text_col), common.shards_for(docs, SHARD_BYTES)
    sets = common.stored(rows.mapInArrow(_sets(n), SETS), "sets")
    heads = sets.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("head"))
    signed = rows.mapInArrow(_sign(n, percent, shards), MESSAGE)
    buckets = common.stored(signed.groupBy("shard").applyInArrow(_buckets, BUCKETS).distinct(), "buckets")
    common.free(spark)

    sketches = sets.where("sketch is not null").join(buckets.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    sketches = common.stored(sketches, "sketches")
    near = _stripes(buckets.join(sketches, "node"), "bucket", STRIPE).applyInArrow(_possible(percent), "u long, v long")
    clusters = common.stored(components(near).withColumnRenamed("component", "cluster"), "clusters")
    common.free(spark)

    wanted = common.stored(clusters.join(heads, "node").where("head is not null").select(F.col("head").alias("doc_id")).distinct(), "wanted")
    few = wanted.count() <= TOLD
    texts = rows.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi")
    whole = common.stored(texts.mapInArrow(_profiles(n), "node long, shingles binary"), "profiles")
    known = clusters.join(clusters.groupBy("cluster").agg(F.count("*").alias("members")), "cluster")
    known = known.join(sketches, "node").join(whole, "node")
    links = _stripes(known, "cluster", SET_STRIPE).applyInArrow(_certain(percent), "u long, v long")
    final = components(links)
    common.discard(buckets, sketches, clusters, wanted, whole)

    heads = heads.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = heads.groupBy("component").agg(F.min("head").alias("component_id"))
    named = heads.select("node", "component").join(least, "component").select("node", "component_id")
    return sets.join(named, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=4, percent=85)
