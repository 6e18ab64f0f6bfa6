"""Operator 9: Katz backoff language model of any order.

Documents become blocks of a few million tokens: a sorted vocabulary of word hashes and the tokens as places in it. A
block sends each shard (a range of hashes) its distinct n-grams of each order, in order and delta coded; a shard adds the
counts of all blocks, stores them as its part of that order's table, and answers each block from that part in the
block's own order. The backoff weights become tables in the same way. So what travels is distinct n-grams of blocks,
never tokens, and no task sees more than its range or its block. ``model_table`` reads the stored model.

The model: Good-Turing discounted counts d(c) * c for c up to ``K``; larger counts lose ``TINY`` of one occurrence, so
that every history has something to give. For a history h, h' being h without its first word,
p(w | h) = d c(h, w) / c(h) where that n-gram was seen, else alpha(h) p(w | h') where the history was seen, else p(w | h');
p(w) = d c(w) / N where the word was seen, else the mass that the discounted words leave. alpha(h) is the mass that h's
n-grams leave over the mass that their words leave in p(. | h'), from sums over all of h's n-grams: exactly normalised.
With an n-gram its end was seen too, so these sums need counts only, and one exchange gives the alphas of all orders. A
token's recursion ends at the longest n-gram that was seen; its logarithm is that n-gram's and the alphas' above. A text
begins in a state of its own that is no token, as often as the order needs.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.scratch import delete
from tidemark.llm.exchange import MESSAGE, each_row, pack, pieces, rows_of, small, trim, unpack, with_answers

#: Counts up to K are discounted by Good-Turing; larger ones lose TINY.
K, TINY = 5, 0.01
#: Words of the longest n-grams. Each further order adds about as much to store and to send as the pairs.
ORDER = 2
#: Tokens of a block; fewer where a partition ends.
BLOCK_TOKENS = 2_300_000
#: Bytes of input files for each shard.
SHARD_BYTES = 16 << 20
END, BEGIN = np.uint64(0x5EED00000000E0D1), np.uint64(0x5EED00000000B091)
BLOCK = "block long, payload binary"
STATS = ", ".join(f"n{i} long" for i in range(1, K + 2))
ANSWER = f"kind string, shard int, block long, payload binary, types long, total long, {STATS}"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def pair_hash(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from that of its history and its last word."""
    return common.mix(h * np.uint64(0x9E3779B97F4A7C15) + common.mix(w + np.uint64(0x632BE59BD9B4E019)))


def begin(n: int) -> np.uint64:
    """Hash of a history of ``n`` beginnings."""
    h = np.array([BEGIN])
    for _ in range(n - 1):
        h = pair_hash(h, np.array([BEGIN]))
    return h[0]


def kind(order: int) -> str:
    return {1: "word", 2: "pair"}.get(order, f"gram{order}")


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


# Blocks ------------------------------------------------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0
    ids: list = []
    sizes: list[np.ndarray] = []
    words: list[np.ndarray] = []
    total = 0

    def block() -> pa.RecordBatch:
        nonlocal made, total
        size = np.concatenate(sizes)
        vocab, tokens = np.unique(np.concatenate(words), return_inverse=True)
        payload = pickle.dumps((ids[:], pack(size.astype(np.uint32), vocab, small(tokens))))
        number = (part << 24) | made
        made, total = made + 1, 0
        for x in (ids, sizes, words):
            x.clear()
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([payload], pa.binary())], ["block", "payload"])

    for b in common.steps(batches):
        w = common.Words(*common.buffer_of(b.column("text")))
        n = np.diff(w.first)
        h = np.insert(w.hashes(lower=True), w.first[1:], END)
        ids += b.column("doc_id").to_pylist()
        sizes.append(n + 1)
        words.append(h)
        total += len(h)
        if total >= BLOCK_TOKENS:
            yield block()
    if ids:
        yield block()


class Block:
    """Tokens of a block, and its distinct pairs in the order of their hashes."""

    def __init__(self, payload: bytes):
        self.ids, raw = pickle.loads(payload)
        size, self.vocab, tokens = unpack(raw)
        self.size, self.tokens = size.astype(np.int64), tokens.astype(np.int32)
        self.end = np.cumsum(self.size)
        self.held = np.array([held_out(i) for i in self.ids], bool)
        self.doc = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.size)
        self.train = ~self.held[self.doc]

    def grams(self, order: int) -> Iterator[Grams]:
        """Words, then the n-grams of each further order up to ``order``."""
        n = len(self.vocab)
        got = Grams(1, self.vocab, np.bincount(self.tokens[self.train], minlength=n), self.tokens, None)
        yield got
        starts, place = self.end - self.size, got.at
        name = self.vocab[self.tokens]
        for k in range(2, order + 1):
            past = np.empty(len(place), np.int32)  # histories as places among the n-grams before; one more is the beginning
            past[1:] = place[:-1]
            past[starts] = len(got.names)
            before = np.empty(len(name), np.uint64)
            before[1:] = name[:-1]
            before[starts] = begin(k - 1)
            name = pair_hash(before, self.vocab[self.tokens])
            names, at = np.unique(name, return_inverse=True)
            place = at.astype(np.int32)
            got = Grams(k, names, np.bincount(place[self.train], minlength=len(names)), place, past)
            yield got


class Grams:
    """A block's distinct n-grams by ascending hash, their counts in training, and each token's n-gram and history."""

    def __init__(self, order: int, names: np.ndarray, count: np.ndarray, at: np.ndarray, past: np.ndarray | None):
        self.order, self.names, self.count, self.at, self.past = order, names, count, at, past


def _ask(shards: int, order: int):
    """Each block's n-grams, by order and shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each_row(batches):
            for g in Block(r["payload"]).grams(order):
                for s, x in pieces(g.names, shards).items():
                    yield rows_of([(kind(g.order), s, r["block"], pack(g.names[x], small(g.count[x])))], MESSAGE)
            del g
            trim()

    return run


def _add(tables: bool):
    """A shard's n-gram table, and for each block its n-grams' counts from it, and which of the pairs seen it is to sum up."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _added(key, table, tables)

    return run


def _added(key: tuple[pa.Scalar, ...], table: pa.Table, tables: bool) -> pa.Table:
    name, shard = key[0].as_py(), key[1].as_py()
    got = [(b, *unpack(p)) for b, p in sorted(zip(table["block"].to_pylist(), table["payload"].to_pylist(), strict=True))]
    every = np.concatenate([g[1] for g in got])
    names, at = np.unique(every, return_inverse=True)
    own = np.concatenate([g[2].astype(np.int64) for g in got])
    total = np.zeros(len(names), np.int64)
    np.add.at(total, at, own)
    seen = total > 0
    where = np.cumsum([0, *(len(g[1]) for g in got)])
    owner = np.full(len(names), len(every))
    trained = np.flatnonzero(own)
    np.minimum.at(owner, at[trained], trained)
    stats = [int((total == i).sum()) for i in range(1, K + 2)]
    rows = [(f"{name} table", shard, None, pack(names[seen], small(total[seen])) if tables else b"", int(seen.sum()), int(total.sum()), *stats)]
    for i, (b, h, _) in enumerate(got):
        mine = at[where[i] : where[i + 1]]
        owned = owner[mine] == np.arange(where[i], where[i] + len(h))
        rows.append((name, shard, b, pack(small(total[mine]), np.packbits(owned)), 0, 0, *[0] * (K + 1)))
    return pa.Table.from_batches([rows_of(rows, ANSWER)])


# The model ---------------------------------------------------------------------------------------------------------


def discounts(n: list[int]) -> np.ndarray:
    """d(c) for c = 0..K by Good-Turing with Katz's renormalisation; n[i] n-grams occur i + 1 times.

    Where too few counts of counts give a ratio outside (0, 1), that count loses half an occurrence over c.
    """
    d = np.ones(K + 1)
    top = (K + 1) * n[K] / n[0] if n[0] else 1.0
    for c in range(1, K + 1):
        ok = n[c - 1] > 0 and top < 1
        r = ((c + 1) * n[c] / (c * n[c - 1]) - top) / (1 - top) if ok else 0.0
        d[c] = r if 0 < r < 1 else 1 - 0.5 / c
    return d


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """d(c) * c for each count; 0 for 0."""
    c = c.astype(np.int64)
    return np.where(c <= K, d[np.minimum(c, K)] * c, c - TINY)


def taken(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """What discounting takes off each count, without the difference of two large numbers; over 0 for counts over 0."""
    c = c.astype(np.int64)
    return np.where(c <= K, (1 - d[np.minimum(c, K)]) * c, TINY)


class Model:
    """What a task needs besides its n-grams: a few numbers."""

    def __init__(self, stats: list[dict]):
        """``stats``: of each order's counts, from words on."""
        self.order, words = len(stats), stats[0]
        self.total, self.types = words["total"], words["types"]
        self.d = [discounts([x[f"n{i}"] for i in range(1, K + 2)]) for x in stats]
        kept = sum(x * self.d[0][i] * i for i, x in enumerate([0, *(words[f"n{i}"] for i in range(1, K + 1))]))
        low = sum(words[f"n{i}"] for i in range(1, K + 1))
        low_tokens = sum(i * words[f"n{i}"] for i in range(1, K + 1))
        kept += (self.total - low_tokens) - TINY * (self.types - low)
        self.unknown = 1 - kept / self.total if self.total else 1.0

    def word(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, discounted(c, self.d[0]) / max(1, self.total), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.total + 0.5 * (self.types + 1)))


def _model(answers: DataFrame, order: int) -> Model:
    names = ["types", "total", *(f"n{i}" for i in range(1, K + 2))]
    rows = answers.where("block is null").groupBy("kind").agg(*(F.sum(c).alias(c) for c in names)).collect()
    found = {r["kind"]: r.asDict() for r in rows}
    return Model([found.get(f"{kind(k)} table", dict.fromkeys(names, 0)) for k in range(1, order + 1)])


def _sum_up(model: Model, shards: int):
    """Scores a block as far as alphas aren't needed; sends its n-grams' sums, and the histories whose alpha it needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each_row(batches):
            b = Block(r["payload"])
            add = lambda v: np.bincount(b.doc, v, len(b.ids))  # noqa: B023, E731
            answers: dict[str, list] = {}
            for a in r["answers"]:
                answers.setdefault(a["kind"], []).append((a["shard"], a["payload"]))
            levels = []  # of each order: log p of seen n-grams, whether seen, whether the history was
            for g in b.grams(model.order):
                c, own, cut = np.zeros(len(g.names), np.int64), np.zeros(len(g.names), bool), pieces(g.names, shards)
                for s, payload in answers.pop(kind(g.order), ()):
                    x = cut[s]
                    count, bits = unpack(payload)
                    c[x] = count
                    own[x] = np.unpackbits(bits, count=x.stop - x.start)
                if g.order == 1:
                    n_begin = int(c[np.searchsorted(b.vocab, END)])  # every document ends once
                    p1 = model.word(c)
                    base, known = add(model.base(c)[g.at]), add((c > 0)[g.at])
                    score, low = np.log10(p1)[g.at], p1[g.at]  # p(. | h') of each token, where seen
                else:
                    c_past = np.append(last, n_begin)  # noqa: F821
                    seen, open_ = c[g.at] > 0, c_past[g.past] > 0
                    levels.append((g.order, seen, open_, g.past, np.append(names, begin(g.order - 1))))  # noqa: F821
                    yield from sums(r["block"], g, c, own, c_past, np.append(names, begin(g.order - 1)), low)  # noqa: F821
                    left = discounted(c, model.d[g.order - 1])
                    low = left[g.at] / np.maximum(1, c_past)[g.past]
                    score = np.where(seen, np.log10(np.where(c > 0, left, 1))[g.at] - np.log10(np.maximum(1, c_past))[g.past], score)
                    del left, c_past, seen, open_
                last, names = c, g.names
                del g, c, own
            score, above = add(score), np.zeros(len(b.tokens), bool)
            needs = []
            for k, seen, open_, past, hist in reversed(levels):  # an alpha for each order over the longest n-gram seen
                above |= seen
                ask = np.flatnonzero(~above & open_)
                need, place = np.unique(past[ask], return_inverse=True)
                names = hist[need]
                order = np.argsort(names)
                rank = np.empty(len(need), np.int64)
                rank[order] = np.arange(len(need))
                needs += [np.bincount(b.doc[ask], minlength=len(b.ids)).astype(np.uint32), small(rank[place])]
                names = names[order]
                for s, x in pieces(names, shards).items():
                    yield rows_of([(f"need{k}", s, r["block"], pack(names[x]))], MESSAGE)
            state = pack(b.size, b.held.astype(np.uint8), known.astype(np.int64), base, score, *needs)
            yield rows_of([("state", -1, r["block"], pickle.dumps((b.ids, state)))], MESSAGE)
            del b, levels, needs, score, base, above, last, names
            trim()

    def sums(block: int, g: Grams, c: np.ndarray, own: np.ndarray, c_past: np.ndarray, hist: np.ndarray, low: np.ndarray) -> Iterator[pa.RecordBatch]:
        """By history: over the n-grams that this block is to sum up, what discounting takes off their counts, and lower probabilities."""
        first = np.empty(len(c), np.int64)
        first[g.at[::-1]] = np.arange(len(g.at) - 1, -1, -1)
        mine = first[own]
        past, where = np.unique(g.past[mine], return_inverse=True)
        off = np.bincount(where, taken(c[own], model.d[g.order - 1]), len(past))
        mass = np.bincount(where, low[mine], len(past))
        names = hist[past]
        order = np.argsort(names)
        names = names[order]
        for s, x in pieces(names, shards).items():
            yield rows_of([(f"sums{g.order}", s, block, pack(names[x], off[order][x], mass[order][x], small(c_past[past][order][x])))], MESSAGE)

    return run


def _alphas(tables: bool):
    """The table of alphas of every history of a shard and order, and each block's answer."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order, shard = key[0].as_py(), key[1].as_py()
        rows = sorted(zip(table["kind"].to_pylist(), table["block"].to_pylist(), table["payload"].to_pylist(), strict=True))
        got = [unpack(p) for k, _, p in rows if k.startswith("sums")]
        names, at = np.unique(np.concatenate([g[0] for g in got] or [np.zeros(0, np.uint64)]), return_inverse=True)
        add = lambda i: np.bincount(at, np.concatenate([g[i] for g in got]), len(names)) if got else np.zeros(0)
        off, mass, total = add(1), add(2), np.zeros(len(names))
        if got:
            total[at] = np.concatenate([g[3] for g in got])
        alpha = off / np.maximum(1, total) / np.maximum(1 - mass, np.finfo(float).eps)
        out = [(f"alpha{order} table", shard, None, pack(names, small(total.astype(np.int64)), alpha))] if tables else []
        for k, b, p in rows:
            if k.startswith("need"):
                (need,) = unpack(p)
                out.append((f"alpha{order}", shard, b, pack(alpha[np.searchsorted(names, need)])))
        return pa.Table.from_batches([rows_of(out, MESSAGE)])

    return run


def _finish(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each_row(batches):
            ids, raw = pickle.loads(r["payload"])
            size, held, known, base, score, *needs = unpack(raw)
            for k in range(model.order, 1, -1):  # answers in the order of hashes, in which the block counted its places
                n, place, *needs = needs
                if len(place):
                    mine = sorted((a["shard"], a["payload"]) for a in r["answers"] if a["kind"] == f"alpha{k}")
                    logs = np.concatenate([np.log10(unpack(p)[0]) for _, p in mine])
                    score = score + np.bincount(np.repeat(np.arange(len(ids)), n), logs[place], len(ids))
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(held.astype(bool)), pa.array(size), pa.array(known), pa.array(np.full(n, model.total, np.int64)), pa.array(base), pa.array(score)],
                [f.strip().split(" ")[0] for f in RESULT.split(",")],
            )

    return run


def _entries(model: Model, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each_row(batches):
            names, count, *alpha = unpack(r["payload"])
            count = count.astype(np.int64)
            weight = alpha[0] if alpha else model.word(count) if order == 1 else discounted(count, model.d[order - 1])
            shard = pa.array(np.full(len(names), r["shard"], np.int32))
            yield pa.RecordBatch.from_arrays([shard, pa.array(names.view(np.int64)), pa.array(count), pa.array(weight.astype(float))], ["shard", "hash", "count", "weight"])

    return run


def model_table(spark: SparkSession, at: str, name: str, order: int = 2) -> DataFrame:
    """shard, hash, count, weight of the model of ``order`` that ``score`` stored in the folder ``at``.

    ``name`` "word": hashes of words and p(w); "pair", "gram3" and so on: ``pair_hash`` of a history and a word, and the
    discounted count; "alpha2" and so on: hashes of that order's histories, their counts and alpha. Hashes are the 64 bits
    as a signed number.
    """
    ngrams = spark.read.schema(ANSWER).parquet(f"{at}/ngrams")
    model = _model(ngrams, order)
    rows = spark.read.schema(MESSAGE).parquet(f"{at}/alphas") if name.startswith("alpha") else ngrams
    found = rows.where(F.col("kind") == f"{name} table").select("shard", "payload")
    of = next((k for k in range(1, order + 1) if kind(k) == name), 0)
    return found.mapInArrow(_entries(model, of), "shard int, hash long, count long, weight double")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tables: bool = True, at: str | None = None, order: int = ORDER) -> DataFrame:
    """Learn n-grams up to ``order`` from the documents that aren't held out, and score all.

    doc_id, held_out, n_tokens (words and one end), n_known (tokens that training has), train_tokens, base_score
    (additively smoothed words), score (log10 probability of the text under the model). Null or empty text: the end
    token alone. The tables of n-grams and alphas are stored by shard in the folder ``at`` (by default one in the shared
    folder) and stay there for ``model_table``; ``tables=False`` leaves them out. Rows with one id are documents of their
    own; a null id is trained on. Without training documents each token has probability 1 under the model. Empty
    table: no rows. Other columns are not read.
    """
    rows = common.texts(docs, id_col, text_col)
    shards = common.shards_for(docs, SHARD_BYTES * 2 // order)
    at = at or common.scratch_path(docs.sparkSession, "katz")
    blocks = _written(rows.mapInArrow(_blocks, BLOCK), f"{at}/blocks")
    asked = blocks.mapInArrow(_ask(shards, order), MESSAGE)
    answers = _written(asked.groupBy("kind", "shard").applyInArrow(_add(tables), ANSWER), f"{at}/ngrams")
    del asked
    common.free(docs.sparkSession)
    model = _model(answers, order)

    summed = common.stored(with_answers(blocks, answers).mapInArrow(_sum_up(model, shards), MESSAGE), "sums")
    delete(docs.sparkSession, f"{at}/blocks")  # every block's state is stored by now
    common.free(docs.sparkSession)
    about = summed.where("shard >= 0").withColumn("of", F.regexp_extract("kind", r"(\d+)$", 1).cast("int"))
    alphas = _written(about.groupBy("of", "shard").applyInArrow(_alphas(tables), MESSAGE), f"{at}/alphas")
    state = summed.where("kind = 'state'").select("block", "payload")
    return with_answers(state, alphas).mapInArrow(_finish(model), RESULT)


def op9_katz_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
