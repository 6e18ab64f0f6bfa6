"""Messages between blocks of documents and shards of a hash range.

A block sends each shard its distinct hashes in order; the shard merges all blocks and answers each in that order. What
travels is sorted, delta coded and compressed, and is combined in the block before it travels, so that neither a hot
key nor a group of copies makes a message larger than the block's distinct keys.
"""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MESSAGE = "kind string, shard int, block long, payload binary"


def trim() -> None:
    """Give freed memory back to the system; workers live on from task to task."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes; ascending 64-bit ones as differences. Bytes of one significance stand together before zstd."""
    codec, out = pa.Codec("zstd", compression_level=1), []
    for a in arrays:
        rising = a.dtype == np.uint64 and len(a) > 1
        d = np.diff(a, prepend=np.uint64(0)) if rising else a
        raw = np.ascontiguousarray(d.view(np.uint8).reshape(len(d), -1).T).tobytes() if len(d) else b""
        out.append((a.dtype.str, rising, len(raw), codec.compress(raw, asbytes=True)))
    return pickle.dumps(out)


def unpack(data: bytes) -> list[np.ndarray]:
    codec, out = pa.Codec("zstd"), []
    for kind, rising, size, raw in pickle.loads(data):
        dtype = np.dtype(kind)
        if not size:
            out.append(np.zeros(0, dtype))
            continue
        flat = np.frombuffer(codec.decompress(raw, size, asbytes=True), np.uint8)
        a = np.ascontiguousarray(flat.reshape(dtype.itemsize, -1).T).reshape(-1).view(dtype)
        out.append(np.cumsum(a, dtype=np.uint64) if rising else a)
    return out


def small(a: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds ``a``."""
    top = int(a.max(initial=0))
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def pieces(h: np.ndarray, shards: int) -> dict[int, slice]:
    """Where the hashes of each shard lie among ascending ones, of the shards that have any: shards are equal ranges of the
    first 32 bits, so that the cost is the block's, however many shards there are."""
    shard = (h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    begin = np.flatnonzero(np.diff(shard)) + 1 if len(h) else np.zeros(0, np.int64)
    ends = [0, *begin.tolist(), len(h)] if len(h) else [0]
    return {int(shard[lo]): slice(lo, hi) for lo, hi in zip(ends, ends[1:])}


def rows_of(rows: list[tuple], names: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [f.strip().split(" ") for f in names.split(",")]
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields, strict=True)], [n for n, _ in fields])


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {n: b.column(j)[i].as_py() for j, n in enumerate(b.schema.names)}


def with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Each block with all that is meant for it; an answer has a bit or a number for each hash that the block sent."""
    one = answers.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("kind", "shard", "payload")).alias("answers"))
    return blocks.join(one, "block", "left")
