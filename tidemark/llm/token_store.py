"""Operator 4: token ids as Parquet list columns.

A store is a folder of Parquet files in ascending document order. Each row is one document: ``part`` and
``part_start`` (its file's number and the ids before it there), ``doc_id``, ``n_tokens`` and ``ids``, a list column.
Ids are dictionary encoded; the integers beside them fall to delta encoding (version-2 pages). Row groups and the rows
of a page are bounded, and the writer adds page indexes, so a reader of some documents or of the metadata alone
touches few pages.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, tokens
from tidemark.llm.exchange import trim

SCHEMA = "part int, part_start long, doc_id long, n_tokens int, ids array<int>"
#: Bytes of a row group and a page, rows of a page; the dictionary page holds any 16-bit vocabulary.
LAYOUT = {
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "512",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "compression": "zstd",
}


def _encode(path: str, spaced: bool, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, start = tokens.encoder(path, spaced), TaskContext.get().partitionId(), 0
        for b in common.steps(batches):
            ids, n = enc.encode(b.column("text"))
            values = np.insert(ids, np.cumsum(n), np.int32(end_id))
            n = n + 1
            ends = np.cumsum(n)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values))
            starts = pa.array(start + ends - n)
            start += int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, np.int32)), starts, b.column("doc_id"), pa.array(n.astype(np.int32)), lists],
                ["part", "part_start", "doc_id", "n_tokens", "ids"],
            )
        trim()

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, *, spaced: bool, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every whole text, append ``end_id``, and write the store.

    Null or empty text: the end id alone. A null id sorts first; rows with one id stay apart, in any order among them.
    Other columns, of whatever name, are not read. An empty table gives an empty store.
    """
    rows = common.texts(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    out = rows.mapInArrow(_encode(tokenizer, spaced, end_id), SCHEMA)
    out.write.options(**LAYOUT).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, part, part_start; no id is read."""
    meta = spark.read.schema(SCHEMA).parquet(path).select("part", "part_start", "doc_id", "n_tokens")
    return meta.join(_bases(spark, path), "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "part", "part_start"
    )


def _bases(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each file: a row for each file, so as many as partitions."""
    sums = spark.read.schema(SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    base, rows = 0, []
    for r in sums:
        rows.append((r["part"], base))
        base += r["n"]
    out = spark.createDataFrame(rows, "part int, base long")
    return F.broadcast(out) if len(rows) <= 100_000 else out


def read_tokens(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """doc_id, ids of the documents in [low, high]; the bounds reach the page index."""
    out = spark.read.schema(SCHEMA).parquet(path)
    if low is not None:
        out = out.where(F.col("doc_id") >= low)
    if high is not None:
        out = out.where(F.col("doc_id") <= high)
    return out.select("doc_id", "ids")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column("ids")
        at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        crc = [zlib.crc32(values[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
        n = np.diff(at).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [b.column("part"), b.column("part_start"), b.column("doc_id"), pa.array(n), pa.array(crc, pa.int64())],
            ["part", "part_start", "doc_id", "n_tokens", "ids_crc32"],
        )


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files of a store."""
    read = spark.read.schema(SCHEMA).parquet(path).select("part", "part_start", "doc_id", "ids")
    got = read.mapInArrow(_digest, "part int, part_start long, doc_id long, n_tokens long, ids_crc32 long")
    return got.join(_bases(spark, path), "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = common.scratch_path(spark, "tokens")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), spaced=True, end_id=0)
    return digests(spark, path)
