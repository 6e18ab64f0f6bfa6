"""Exact cosine self-join of sparse vectors by prefix-filtered inverted lists.

Columns are ordered by how many rows have them, rare ones first. A unit vector's prefix ends where the length of what is left
falls under the threshold t. If x and y are t-similar, let x's prefix be the one that ends first: columns past its end add
less than t, so x and y share a column in both prefixes. Only prefixes are joined; what a pair shares there, plus the
length that the earlier-ending one has left, bounds its similarity, and pairs under t go before whole vectors meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rounding of sums that a bound must not fall under.
SLACK = 1e-9


def prefixes(sparse: DataFrame, threshold: float) -> DataFrame:
    """row, at (order of the column), v (of the unit vector), ends (order of the prefix's last column), left (length after
    it), of all columns in prefixes.

    Rows of zeros have none. ``sparse``: row, col, v; a column that a row has twice counts with its sum, null values not.
    """
    cells = sparse.where("row is not null and col is not null and v is not null").groupBy("row", "col").agg(F.sum(F.col("v").cast("double")).alias("v")).where("v <> 0")
    # The order is any total order that all rows agree on: frequency, then the column.
    of = cells.groupBy("col").agg(F.count("*").alias("n")).select("col", F.struct("n", "col").alias("at"))
    x = cells.join(of, "col")
    norm = F.sqrt(F.sum(F.col("v") * F.col("v")).over(Window.partitionBy("row")))
    x = x.withColumn("v", F.col("v") / norm)
    after = Window.partitionBy("row").orderBy(F.desc("at"))
    x = x.withColumn("from_here", F.sqrt(F.sum(F.col("v") * F.col("v")).over(after.rowsBetween(Window.unboundedPreceding, 0))))
    # a column is in the prefix while it and what follows are long enough together
    x = x.where(F.col("from_here") >= threshold - SLACK)
    last = Window.partitionBy("row")
    x = x.withColumn("ends", F.max("at").over(last)).withColumn("here", F.min(F.struct("from_here", "v")).over(last))
    left = F.sqrt(F.greatest(F.lit(0.0), F.col("here.from_here") * F.col("here.from_here") - F.col("here.v") * F.col("here.v")))
    return x.select("row", "at", "v", "ends", left.alias("left"))


def candidates(sparse: DataFrame, threshold: float) -> DataFrame:
    """a < b of rows whose prefixes do not rule out a similarity of ``threshold``."""
    p = prefixes(sparse, threshold)
    a, b = p.toDF("a", "at", "va", "ea", "la"), p.toDF("b", "at", "vb", "eb", "lb")
    met = a.join(b, "at").where("a < b").groupBy("a", "b").agg(
        F.sum(F.when(F.col("at") <= F.least("ea", "eb"), F.col("va") * F.col("vb"))).alias("shared"),
        F.first(F.when(F.col("ea") < F.col("eb"), F.col("la")).when(F.col("eb") < F.col("ea"), F.col("lb")).otherwise(F.least("la", "lb"))).alias("left"),
    )
    return met.where(F.col("shared") + F.col("left") >= threshold - 2 * SLACK).select("a", "b")


def _dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b and the inner product of the vectors (lists of column number and value) of each row."""
    for batch in batches:
        flat = []
        for c in ("x", "y"):
            vec = batch.column(c)
            offs = vec.offsets.to_numpy().astype(np.int64)
            cells = vec.values.slice(offs[0], offs[-1] - offs[0])
            pair = np.repeat(np.arange(batch.num_rows), np.diff(offs))
            flat.append((pair, cells.field(0).to_numpy(zero_copy_only=False), cells.field(1).to_numpy(zero_copy_only=False)))
        (p, c, v), (q, d, w) = flat
        at = np.unique(np.append(c, d), return_inverse=True)[1]
        width = int(at.max(initial=0)) + 1
        _, i, j = np.intersect1d(p * width + at[: len(c)], q * width + at[len(c) :], assume_unique=True, return_indices=True)
        dot = np.bincount(p[i], v[i] * w[j], batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(dot)], ["a", "b", "similarity"])


def similar_pairs(sparse: DataFrame, threshold: float) -> DataFrame:
    """a < b, similarity: all pairs of rows whose cosine is ``threshold`` (over 0) or more.

    ``sparse``: row, col, v of any types that order; signs may differ. Null cells don't count, rows of zeros are like
    nothing, empty table: no rows. The work is that of pairs which share a column of both prefixes; as ``threshold`` falls
    to 0 that is every pair that shares a column.
    """
    assert threshold > 0
    names = sparse.schema["row"].dataType.simpleString()
    cells = sparse.where("row is not null and col is not null and v is not null").groupBy("row", "col").agg(F.sum(F.col("v").cast("double")).alias("v")).where("v <> 0")
    whole = cells.groupBy("row").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("n"), F.collect_list(F.struct(F.xxhash64("col").alias("c"), "v")).alias("vec"))
    whole = whole.select("row", F.transform("vec", lambda s: F.struct(s["c"].alias("c"), (s["v"] / F.col("n")).alias("v"))).alias("vec"))
    met = candidates(sparse, threshold).join(whole.toDF("a", "x"), "a").join(whole.toDF("b", "y"), "b")
    found = met.select("a", "b", "x", "y").mapInArrow(_dots, f"a {names}, b {names}, similarity double")
    return found.where(F.col("similarity") >= threshold)
