"""Operator 11: how far the sources of a language diverge in their words, exactly.

Terms are runs of letters and non-ASCII characters, A-Z lower-cased; a language keeps the V terms in at least
``LEAST_DOCS`` of its documents. A group (lang, source) or a language gives a kept term p = 1 + floor(10^9 (count + 1) /
(N + V)). The divergence of group a from group b is the sum over all kept terms of f = floor((pa - pb)^2 / pb).

The sum is split by how many groups have a term. A term in more than ``LIGHT`` groups is heavy: its p's stand in dense
tiles of terms by groups, and numpy sums f over a tile for blocks of groups. The rest are light: a pair of groups gets
V f(a0, b0) as if no term occurred (a0, b0: p at count 0), then what each group's own light terms change, from a histogram
of their p's, then a correction for each pair of groups in a term's posting list, ``LIGHT`` long at most. All is integer
arithmetic, so the parts add up exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common

SCALE = 1_000_000_000
LEAST_DOCS = 3
#: Groups in a light term's posting list at most.
LIGHT = 8
#: Groups in a block of a dense tile, terms in a tile.
BLOCK, TILE = 256, 512
#: Parts that a group's histogram of light terms is dealt into.
CHUNKS = 16
#: Entries of heavy terms that one partial matrix of a pair of blocks is made from, about.
ENTRIES = 1 << 17
#: Groups that are broadcast at most; each is two short strings and a few numbers.
MOST_BROADCAST = 20_000
STEP_BYTES = 8_000_000

_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_PAIRS = "lang string, a int, b int, value long"


def terms_of(data: np.ndarray, offs: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Terms of all texts in a row, and the text of each. Every byte of a non-ASCII character is above 0x7F."""
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    start = np.flatnonzero(opens)
    kept = _FOLD[data[inside]]
    at = np.flatnonzero(opens[inside])
    ends = np.append(at, len(kept))
    terms = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(kept))
    return terms, np.searchsorted(offs, start, "right") - 1


def _sums(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys ascending, and each column's sums by key, in integers."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], *(np.add.reduceat(v[order], first) if len(first) else v for v in values)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each group and term of about ``STEP_BYTES`` of text: occurrences and documents."""
    for b in common.steps(batches, STEP_BYTES):
        terms, doc = terms_of(*common.buffer_of(b.column("text")))
        if not len(terms):
            continue
        coded = terms.dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lang, source = (b.column(c).dictionary_encode() for c in ("lang", "source"))
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        size = len(words)
        both, n = _sums(doc.astype(np.int64) * size + code, np.ones(len(code), np.int64))
        key, n, docs = _sums(group[both // size] * size + both % size, n, np.ones(len(both), np.int64))
        of = key // size
        yield pa.RecordBatch.from_arrays(
            [
                lang.dictionary.take(pa.array(of // len(source.dictionary))).cast(pa.string()),
                source.dictionary.take(pa.array(of % len(source.dictionary))).cast(pa.string()),
                words.take(pa.array(key % size)).cast(pa.string()),
                pa.array(n),
                pa.array(docs),
            ],
            ["lang", "source", "term", "n", "docs"],
        )


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """f; p and q are under 2^30, so all fits 64 bits."""
    d = p - q
    return d * d // q


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, gi, p0, v, hist, gis, p0s): what group gi's base and light terms give its pairs with a block of groups."""
    for b in batches:
        cols = {c: b.column(c).to_pylist() for c in ("lang", "gi", "p0", "v")}
        hist, gis, p0s = b.column("hist"), b.column("gis"), b.column("p0s")
        for i in range(b.num_rows):
            g, a0, v = cols["gi"][i], np.int64(cols["p0"][i]), np.int64(cols["v"][i])
            others, b0 = (np.asarray(c[i].values.to_numpy(zero_copy_only=False)) for c in (gis, p0s))
            base, back = divergence(a0, b0), divergence(b0, a0)
            there, again = v * base, np.zeros(len(b0), np.int64)
            if len(h := hist[i].values):
                ps, ns = (h.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                for lo in range(0, len(ps), 4096):
                    p, n = ps[lo : lo + 4096, None], ns[lo : lo + 4096, None]
                    there = there + (n * (divergence(p, b0[None]) - base)).sum(axis=0)
                    again = again + (n * (divergence(b0[None], p) - back)).sum(axis=0)
            other = others != g
            there, again, others = there[other], again[other], others[other].astype(np.int32)
            own, lang = np.full(len(others), g, np.int32), pa.repeat(cols["lang"][i], 2 * len(others))
            yield pa.RecordBatch.from_arrays(
                [lang, pa.array(np.append(own, others)), pa.array(np.append(others, own)), pa.array(np.append(there, again))], ["lang", "a", "b", "value"]
            )


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, post: list of (gi, p, p0)), of 2 to LIGHT entries: corrections for each two groups that share a term."""
    for b in batches:
        lang, post = b.column("lang").dictionary_encode(), b.column("post")
        offs = post.offsets.to_numpy().astype(np.int64)
        flat = post.values
        gi, p, p0 = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
        of, size = lang.indices.to_numpy().astype(np.int64), np.diff(offs)
        keys, values = [], []
        for m in np.unique(size):
            rows = np.flatnonzero(size == m)
            at = offs[rows][:, None] + np.arange(m)
            i, j = (x.ravel() for x in np.nonzero(~np.eye(m, dtype=bool)))
            x, y = at[:, i], at[:, j]
            corr = divergence(p[x], p[y]) - divergence(p[x], p0[y]) - divergence(p0[x], p[y]) + divergence(p0[x], p0[y])
            keys.append(np.stack([np.repeat(of[rows], len(i)), gi[x].ravel(), gi[y].ravel()]))
            values.append(corr.ravel())
        if not keys:
            continue
        k = np.concatenate(keys, axis=1)
        groups = int(gi.max()) + 1
        key, total = _sums((k[0] * groups + k[1]) * groups + k[2], np.concatenate(values))
        yield _pairs(lang.dictionary.take(pa.array(key // groups // groups)), key // groups % groups, key % groups, total)


def _pairs(lang: pa.Array, a: np.ndarray, b: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang.cast(pa.string()), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(value)], ["lang", "a", "b", "value"])


class _Tiles:
    """Sums of f - f(a0, b0) over the heavy terms of one bucket, for the groups of two blocks."""

    def __init__(self, key: tuple, gi: np.ndarray, p0: np.ndarray):
        order = np.argsort(gi)
        self.key, self.gi, self.p0 = key, gi[order], p0[order]
        self.f0 = divergence(self.p0[:, None], self.p0[None])
        self.total = np.zeros_like(self.f0)
        blk = self.gi // BLOCK
        self.columns = range(len(gi))
        self.wanted = (self.gi[:, None] != self.gi[None]) & ((blk[:, None] != blk[None]) | (key[1] == key[2]))

    def add(self, term: np.ndarray, gi: np.ndarray, p: np.ndarray) -> None:
        """term: an ascending number for each entry; an entry's group is one of the two blocks'."""
        at, pos = np.unique(term, return_inverse=True)[1], np.searchsorted(self.gi, gi)
        count = int(at[-1]) + 1
        for lo in range(0, count, TILE):
            i, j = np.searchsorted(at, (lo, lo + TILE))
            size = min(TILE, count - lo)
            tile = np.repeat(self.p0[None], size, axis=0)
            tile[at[i:j] - lo, pos[i:j]] = p[i:j]
            for b in self.columns:
                rows = np.flatnonzero(self.wanted[:, b])
                self.total[rows, b] += divergence(tile[:, rows], tile[:, b : b + 1]).sum(axis=0) - size * self.f0[rows, b]

    def result(self) -> pa.RecordBatch:
        a, b = np.nonzero(self.wanted & (self.total != 0))
        return _pairs(pa.repeat(self.key[0], len(a)), self.gi[a], self.gi[b], self.total[a, b])


def _dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, lo, hi, bucket, term, gi, p) sorted by these; with a null term, a group and its p0, ahead of the terms. One
    tile, a matrix of two blocks and a batch are in memory."""
    tiles, heads, rest = None, [], None
    for batch in batches:
        batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0] if rest is not None and rest.num_rows else batch
        if not batch.num_rows:
            continue
        lang, term = (batch.column(c).dictionary_encode() for c in ("lang", "term"))
        lo, hi, bucket, gi, p = (batch.column(c).to_numpy() for c in ("lo", "hi", "bucket", "gi", "p"))
        code = term.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        part = np.stack([lang.indices.to_numpy(), lo, hi, bucket])
        fresh = np.append(True, (part[:, 1:] != part[:, :-1]).any(axis=0))
        change = np.flatnonzero(np.append(True, fresh[1:] | (code[1:] != code[:-1])))
        number = np.zeros(batch.num_rows, np.int64)
        number[change[1:]] = 1
        number = np.cumsum(number)
        last = int(change[-1])  # the last term may go on in the next batch
        cuts = [*np.flatnonzero(fresh[:last]), last]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            key = (lang[i].as_py(), int(lo[i]), int(hi[i]), int(bucket[i]))
            head = slice(i, i + int(np.argmax(np.append(code[i:j], 0) >= 0)))
            tail = slice(head.stop, j)
            if tiles is not None and tiles.key != key:
                yield tiles.result()
                tiles = None
            if head.stop > head.start:
                heads = [x for x in heads if x[0] == key] + [(key, gi[head], p[head])]
            if tail.stop > tail.start:
                if tiles is None:
                    tiles, heads = _Tiles(key, *(np.concatenate([x[k] for x in heads if x[0] == key]) for k in (1, 2))), []
                tiles.add(number[tail], gi[tail], p[tail])
        rest = batch.slice(last)
    if rest is not None and rest.num_rows and rest.column("term")[0].is_valid:
        r = rest.to_pydict()
        key = (r["lang"][0], r["lo"][0], r["hi"][0], r["bucket"][0])
        if tiles is not None and tiles.key != key:
            yield tiles.result()
            tiles = None
        if tiles is None:
            tiles = _Tiles(key, *(np.concatenate([x[k] for x in heads if x[0] == key]) for k in (1, 2)))
        tiles.add(np.zeros(rest.num_rows, np.int64), np.array(r["gi"]), np.array(r["p"]))
    if tiles is not None:
        yield tiles.result()


def _share(count: str, total: str):
    """p of a count, in decimals: a count may pass 10^9."""
    wide = "cast({} as decimal(20,0))"
    return F.expr(f"1 + cast((cast({SCALE} as decimal(10,0)) * {wide.format(f'({count}) + 1')}) div {wide.format(total)} as bigint)")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, most_terms: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows for each two sources of a language, ``term`` rows for each
    source's most over-used terms.

    Null text, lang and source are empty strings, and the empty lang and source are values like others. A group without a
    kept term, or without any, has its pairs; a language that keeps no term has pairs of value 0; a language of one source
    has no pair. Ties rank by item in byte order. Repeated rows are documents of their own; ids are not read, nor are other
    columns. A text of any length is one step of at least ``STEP_BYTES``. Empty table: no rows.

    The number of ``pair`` rows is the square of a language's sources, as asked for; nothing else grows so but blocks of the
    dense sums. A hot source is pre-aggregated where it is read; its entries are dealt by term.
    """
    spark = docs.sparkSession
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(text("lang"), text("source"), text("text"))
    tallied = rows.mapInArrow(_tally, "lang string, source string, term string, n long, docs long")
    tallied = tallied.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    kept = tallied.select(
        "lang", "term", "source", "n", F.sum("docs").over(term).alias("df"), F.sum("n").over(term).alias("total"),
        F.count("*").over(term).alias("groups"), (F.row_number().over(term.orderBy("source")) == 1).alias("lead"),
    )
    kept = common.stored(kept.where(F.col("df") >= least_docs).drop("df"), "terms")

    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count_if("lead").alias("v"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = rows.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["group_n", "lang_n", "v"])
    groups = groups.withColumn("gi", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = groups.withColumn("blocks", F.expr(f"cast((count(*) over (partition by lang) + {BLOCK - 1}) div {BLOCK} as int)"))
    groups = common.stored(groups.withColumn("p0", F.when(F.col("v") > 0, _share("0", "group_n + v")).otherwise(F.lit(1).cast("long"))), "groups")
    small = groups.count() <= MOST_BROADCAST
    named = (F.broadcast if small else lambda x: x)(groups)
    entries = kept.join(named, ["lang", "source"]).withColumn("p", _share("n", "group_n + v"))

    over = entries.withColumn("q", _share("total", "lang_n + v")).where("p > q")
    over = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))

    # each group's base and light terms against blocks of groups
    light, heavy = entries.where(F.col("groups") <= LIGHT), entries.where(F.col("groups") > LIGHT)
    chunk = lambda c: F.pmod(F.hash(c), F.lit(CHUNKS)).alias("chunk")
    hist = light.groupBy("lang", "gi", "p0", "p").agg(F.count("*").alias("n"))
    hist = hist.groupBy("lang", "gi", "p0", chunk("p")).agg(F.collect_list(F.struct("p", "n")).alias("hist")).withColumn("v", F.lit(0).cast("long"))
    base = groups.select("lang", "gi", "p0", chunk("gi"), F.expr("cast(array() as array<struct<p:bigint,n:bigint>>)").alias("hist"), "v")
    blocks = groups.groupBy("lang", F.expr(f"gi div {BLOCK}").alias("blk")).agg(F.collect_list("gi").alias("gis"), F.collect_list("p0").alias("p0s"))
    blocks = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(CHUNKS - 1))))
    parts = base.unionByName(hist).join(blocks, ["lang", "chunk"]).mapInArrow(_spread, _PAIRS)

    # light terms that two groups share
    posts = light.where("groups > 1").groupBy("lang", "term").agg(F.collect_list(F.struct("gi", "p", "p0")).alias("post"))
    parts = parts.unionByName(posts.select("lang", "post").mapInArrow(_postings, _PAIRS))

    # heavy terms in dense tiles
    many = kept.where(F.col("groups") > LIGHT).count()
    buckets = max(1, -(-many // ENTRIES))
    halves = lambda df: (
        df.withColumn("k", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("lo", F.expr(f"least(gi div {BLOCK}, k)").cast("int"))
        .withColumn("hi", F.expr(f"greatest(gi div {BLOCK}, k)").cast("int"))
    )
    cols = ["lang", "lo", "hi", "bucket", "term", "gi", "p"]
    heads = halves(groups).withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))).withColumn("term", F.lit(None).cast("string"))
    body = halves(heavy).withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    dense = heads.withColumn("p", F.col("p0")).select(*cols).unionByName(body.select(*cols))
    dense = dense.repartition("lang", "lo", "hi", "bucket").sortWithinPartitions(*[F.asc_nulls_first(c) for c in cols])
    parts = parts.unionByName(dense.mapInArrow(_dense, _PAIRS))

    pairs = parts.groupBy("lang", "a", "b").agg(F.sum(F.col("value").cast("decimal(20,0)")).cast("long").alias("value"))
    name = lambda i, c: named.select("lang", F.col("gi").alias(i), F.col("source").alias(c))
    pairs = pairs.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = pairs.withColumn("rank", rank).unionByName(over.withColumn("rank", rank).where(F.col("rank") <= most_terms))
    return ranked.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The same in SQL.
ORACLE = f"""with d as (select row_number() over () as rn, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
 t as (select lang, source, rn, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
 k as (select lang, term, count(*) as c from t group by lang, term having count(distinct rn) >= {LEAST_DOCS}),
 n as (select t.lang, t.source, t.term, count(*) as c from t join k using (lang, term) group by 1, 2, 3),
 l as (select lang, count(*) as v, sum(c) as total from k group by 1),
 g as (select d.lang, d.source, coalesce(max(x.s), 0) as total from (select distinct lang, source from d) d left join (select lang, source, sum(c) as s from n group by 1, 2) x using (lang, source) group by 1, 2),
 p as (select g.lang, g.source, k.term, coalesce(n.c, 0) as c, 1 + ({SCALE}::hugeint * (coalesce(n.c, 0) + 1)) // (g.total + l.v) as p,
   1 + ({SCALE}::hugeint * (k.c + 1)) // (l.total + l.v) as q from g join l using (lang) join k using (lang) left join n on n.lang = g.lang and n.source = g.source and n.term = k.term),
 s as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
 pairs as (select x.lang, x.source, 'pair' as part, y.source as item, coalesce(s.value, 0)::bigint as value from g x join g y on x.lang = y.lang and x.source <> y.source
   left join s on s.lang = x.lang and s.source = x.source and s.item = y.source),
 terms as (select lang, source, 'term' as part, term as item, (((p - q) * (p - q)) // q)::bigint as value from p where c > 0 and p > q),
 r as (select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from (select * from pairs union all select * from terms))
 select lang, source, part, item, value, rank::int as rank from r where part = 'pair' or rank <= 200"""
