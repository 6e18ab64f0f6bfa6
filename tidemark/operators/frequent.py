"""Enrichment of documents with the n-grams that many documents hold, without a shuffle of the n-grams.

Cleaned documents are stored in blocks. A block sends each shard of a hash range its distinct hashes (40 bits, as packed
differences) and in how many of its documents each lies; the shard adds them up and answers with a bit for each hash. Only
n-grams with such a bit are counted as strings, so that equal hashes of different n-grams are found; those that have too few
documents by themselves are told to the blocks. An n-gram is a span of the cleaned text, so nothing is copied to hash it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import clean
from tidemark.operators import dictionary
from tidemark.scratch import free, stored

#: Bytes of cleaned text in a block, about (a longer document is a block of its own), and its documents at most.
BLOCK_BYTES, BLOCK_DOCS = 4_000_000, 1 << 20
#: Bits of a hash, and of a document's number beside it.
BITS, DOC_BITS = 40, 24
#: Bytes of cleaned text for each shard, about.
SHARD_BYTES = 12_000_000

_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the hash's base modulo 2^64, and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = []
        for x in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n, x, np.uint64)
            p[:1] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS


class Spans:
    """The n-grams of a block's texts, by n and then place: ``begin`` and ``end`` in ``flat``, ``doc``, ``hash``."""

    def __init__(self, texts: pa.Array, most: int, bits: int):
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
        at = at - at[0]
        word = flat != 32
        first, last = ~word, ~word
        first, last = np.append(True, first)[: len(flat)], np.append(last, True)[1:]
        full = at[:-1] < at[1:]
        first[at[:-1][full]], last[at[1:][full] - 1] = True, True
        s, e = np.flatnonzero(word & first), np.flatnonzero(word & last) + 1
        doc = np.searchsorted(at, s, "right") - 1
        power, back = _powers(len(flat) + 1)
        total = np.append(np.uint64(0), np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[: len(flat)], dtype=np.uint64))
        parts = []
        for n in range(2, most + 1):
            same = np.flatnonzero(doc[: max(0, len(s) - n + 1)] == doc[n - 1 :])
            parts.append((s[same], e[same + n - 1], doc[same]))
        self.flat, self.at = flat, at
        self.begin, self.end, self.doc = (np.concatenate([p[i] for p in parts]) for i in range(3))
        h = (total[self.end] - total[self.begin]) * back[self.begin]
        for shift, times in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(times)
        self.hash = h >> np.uint64(64 - bits)

    def only(self, kept: np.ndarray) -> Spans:
        for name in ("begin", "end", "doc", "hash"):
            setattr(self, name, getattr(self, name)[kept])
        return self

    def words(self) -> pa.Array:
        """The n-grams, their words joined by ``_``."""
        size = self.end - self.begin
        ends = np.append(0, np.cumsum(size))
        out = self.flat[np.arange(ends[-1]) + np.repeat(self.begin - ends[:-1], size)]
        out[out == 32] = 95
        return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(out)])


def _pack(rising: np.ndarray) -> bytes:
    """Ascending 32-bit numbers: differences, bytes of one significance together, zstd."""
    d = np.diff(rising, prepend=np.uint32(0)).astype("<u4")
    return pa.compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(4, n).T).view("<u4").reshape(-1), dtype=np.uint32)


def _distinct(numbers: np.ndarray) -> np.ndarray:
    x = np.sort(numbers)
    return x[np.append(True, x[1:] != x[:-1])[: len(x)]]


def _lists(column: pa.Array, i: int) -> pa.Array:
    """The elements of one list."""
    lo, hi = column.offsets[i].as_py(), column.offsets[i + 1].as_py()
    return column.values.slice(lo, hi - lo)


def _blocks(docs: DataFrame, key: str, block_bytes: int) -> DataFrame:
    """Stored blocks: block, bytes, keys and texts of its documents."""
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, rows, number = [], 0, 0, TaskContext.get().partitionId() << 32

        def made() -> pa.RecordBatch:
            keys, texts = (pa.concat_arrays([b.column(i) for b in waiting]) for i in (0, 1))
            at = pa.array([0, len(keys)], pa.int32())
            lists = [pa.ListArray.from_arrays(at, x) for x in (keys, texts)]
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([size]), *lists], ["block", "bytes", "keys", "texts"])

        for b in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            lo = 0
            while lo < b.num_rows:
                before = int(ends[lo - 1]) if lo else 0
                hi = min(max(lo + 1, int(np.searchsorted(ends, before + block_bytes - size, "right"))), lo + BLOCK_DOCS - rows)
                waiting.append(b.slice(lo, hi - lo))
                size, rows = size + int(ends[hi - 1]) - before, rows + hi - lo
                if hi < b.num_rows or size >= block_bytes or rows >= BLOCK_DOCS:
                    yield made()
                    waiting, size, rows, number = [], 0, 0, number + 1
                lo = hi
        if waiting:
            yield made()

    x = docs.mapInArrow(cut, f"block long, bytes long, keys array<{kind}>, texts array<string>")
    # a reader holds a row group; unasked, Parquet looks at its (packed) bytes after a hundred rows
    small = {"parquet.block.row.count.limit": 2, "parquet.page.size.row.check.min": 1}
    return stored(x, "blocks", **{"parquet.block.size": 4 * block_bytes, "parquet.page.size": block_bytes, **small})


def _sender(most: int, least: int, bits: int, shard_bits: int):
    rest = np.uint64(bits - shard_bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x = Spans(_lists(b.column("texts"), i), most, bits)
                each = _distinct((x.hash << np.uint64(DOC_BITS)) | x.doc.astype(np.uint64)) >> np.uint64(DOC_BITS)
                if not len(each):
                    continue
                at = np.flatnonzero(np.append(True, each[1:] != each[:-1]))
                h, n = each[at], np.minimum(np.diff(np.append(at, len(each))), least).astype("<i4")
                shard = h >> rest
                low = (h & ((np.uint64(1) << rest) - np.uint64(1))).astype(np.uint32)
                cut = [*np.flatnonzero(np.append(True, shard[1:] != shard[:-1])).tolist(), len(h)]
                pairs = list(zip(cut, cut[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard[cut[:-1]].astype(np.int32)), pa.array([b.column("block")[i].as_py()] * len(pairs), pa.int64()), pa.array([q - p for p, q in pairs], pa.int32()),
                        pa.array([_pack(low[p:q]) for p, q in pairs]), pa.array([pa.compress(n[p:q].tobytes(), "zstd", asbytes=True) for p, q in pairs]),
                    ],
                    ["shard", "block", "n", "hashes", "counts"],
                )

    return send


def _adder(least: int):
    def add(messages: pa.Table) -> pa.Table:
        sizes = messages["n"].to_pylist()
        h = np.concatenate([_unpack(m, n) for m, n in zip(messages["hashes"].to_pylist(), sizes)])
        c = np.concatenate([np.frombuffer(pa.decompress(m, 4 * n, "zstd", asbytes=True), "<i4") for m, n in zip(messages["counts"].to_pylist(), sizes)])
        order = np.argsort(h, kind="stable")
        h = h[order]
        at = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        enough = np.add.reduceat(c[order].astype(np.int64), at) >= least
        flags = np.empty(len(h), np.uint8)
        flags[order] = np.repeat(enough, np.diff(np.append(at, len(h))))
        ends = np.cumsum(sizes).tolist()
        bits = [np.packbits(flags[q - n : q]).tobytes() for q, n in zip(ends, sizes)]
        return pa.table({"block": messages["block"], "shard": messages["shard"], "bits": pa.array(bits, pa.binary())})

    return add


def _frequent(batch: pa.RecordBatch, i: int, most: int, bits: int, shard_bits: int) -> Spans:
    """The spans of a block whose hashes have enough documents."""
    x = Spans(_lists(batch.column("texts"), i), most, bits)
    h = _distinct(x.hash)
    good = np.zeros(len(h), bool)
    for a in batch.column("answers")[i].as_py() or []:
        lo, hi = (int(np.searchsorted(h, np.uint64(s << (bits - shard_bits)))) for s in (a["shard"], a["shard"] + 1))
        good[lo:hi] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=hi - lo)
    return x.only(good[np.searchsorted(h, x.hash)])


def _counter(most: int, bits: int, shard_bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x = _frequent(b, i, most, bits, shard_bits)
                words = x.words().dictionary_encode()
                codes = words.indices.to_numpy().astype(np.int64)
                df = np.bincount(_distinct((codes << DOC_BITS) | x.doc) >> DOC_BITS, minlength=len(words.dictionary))
                yield pa.RecordBatch.from_arrays([words.dictionary.cast(pa.string()), pa.array(df)], ["word", "df"])

    return count


def _writer(most: int, bits: int, shard_bits: int, glue: bool, key: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                texts = _lists(b.column("texts"), i)
                x = _frequent(b, i, most, bits, shard_bits)
                wrong = _lists(b.column("wrong"), i)
                if len(wrong):
                    like = Spans(pc.replace_substring(wrong, "_", " "), most, bits)  # longer ones hold shorter, which does no harm
                    maybe = np.flatnonzero(np.isin(x.hash, like.hash))
                    y = Spans(texts.slice(0, 0), most, bits)
                    y.flat, y.begin, y.end = x.flat, x.begin[maybe], x.end[maybe]
                    drop = maybe[pc.is_in(y.words().cast(pa.string()), value_set=wrong).to_numpy(zero_copy_only=False)]
                    x.only(np.delete(np.arange(len(x.hash)), drop))
                yield _written(x, texts, _lists(b.column("keys"), i), glue, key)

    return write


def _written(x: Spans, texts: pa.Array, keys: pa.Array, glue: bool, key: str) -> pa.RecordBatch:
    """Each text, then its spans by n and place (in this order already), with a blank before each; the first one's as asked."""
    order = np.argsort(x.doc, kind="stable")
    begin, end, doc = x.begin[order], x.end[order], x.doc[order]
    first = np.append(True, doc[1:] != doc[:-1])[: len(doc)]
    blank = ~first if glue else np.ones(len(doc), bool)
    # pieces: the texts and the spans, each text before its spans
    size = end - begin + blank
    docs = np.arange(len(texts))
    rank = np.argsort(np.append(docs, doc), kind="stable")
    source = np.append(x.at[:-1], begin - blank)[rank]
    length = np.append(np.diff(x.at), size)[rank]
    gram, lead = (np.append(np.zeros(len(docs), bool), f)[rank] for f in (np.ones(len(doc), bool), blank))
    ends = np.append(0, np.cumsum(length))
    index = np.arange(ends[-1]) + np.repeat(source - ends[:-1], length)
    out = x.flat[np.maximum(index, 0)] if len(x.flat) else np.zeros(0, np.uint8)
    out[(out == 32) & np.repeat(gram, length)] = 95
    out[ends[:-1][lead]] = 32
    whole = np.append(0, np.cumsum(np.bincount(np.append(docs, doc)[rank], length, len(docs)).astype(np.int64))).astype(np.int32)
    made = pa.Array.from_buffers(pa.string(), len(docs), [None, pa.py_buffer(whole), pa.py_buffer(out)])
    made = pc.if_else(texts.is_valid(), made, pa.scalar(None, pa.string())) if texts.null_count else made
    return pa.RecordBatch.from_arrays([keys, made], [key, "text_ngramized"])


def ngramize_frequent(
    docs: DataFrame, most: int = 3, least: int = 5, glue: bool = True, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, bits: int = BITS
) -> DataFrame:
    """Cleaned text followed by its n-grams (two words to ``most``) that ``least`` documents hold, by n, then place: as
    ``dictionary.ngramize`` with that dictionary, which also serves where keys repeat or are null."""
    assert 1 < most and bits <= BITS
    if docs.groupBy(key).count().where(F.col(key).isNull() | (F.col("count") > 1)).limit(1).count():
        return _by_words(docs, most, least, glue, key, text)
    blocks = _blocks(docs.select(key, clean(F.col(text)).alias("text")), key, block_bytes)
    size = blocks.agg(F.sum("bytes")).first()[0] or 0
    shard_bits = min(max(bits - 32, (size // shard_bytes).bit_length(), 3), bits)
    messages = blocks.select("block", "texts").mapInArrow(_sender(most, least, bits, shard_bits), "shard int, block long, n int, hashes binary, counts binary")
    answers = stored(messages.groupBy("shard").applyInArrow(_adder(least), "block long, shard int, bits binary"), "answers")
    free(docs.sparkSession)  # the messages
    of = answers.groupBy("block").agg(F.collect_list(F.struct("shard", "bits")).alias("answers"))
    asked = blocks.join(of.hint("shuffle_hash"), "block", "left")
    counts = asked.select("texts", "answers").mapInArrow(_counter(most, bits, shard_bits), "word string, df long").groupBy("word").agg(F.sum("df").alias("df"))
    wrong = stored(counts.where(F.col("df") < least).select("word"), "wrong")
    free(docs.sparkSession)
    if wrong.count() > dictionary.MOST_TOLD:
        return _by_words(docs, most, least, glue, key, text)
    told = asked.crossJoin(F.broadcast(wrong.agg(F.collect_list("word").alias("wrong"))))
    kind = docs.schema[key].dataType.simpleString()
    return told.select("keys", "texts", "answers", "wrong").mapInArrow(_writer(most, bits, shard_bits, glue, key), f"{key} {kind}, text_ngramized string")


def _by_words(docs: DataFrame, most: int, least: int, glue: bool, key: str, text: str) -> DataFrame:
    known = dictionary.word_counts(docs, most, key, text).where((F.col("n_gram_len") >= 2) & (F.col("document_frequency") >= least))
    return dictionary.ngramize(docs, known, most, glue, key, text)
