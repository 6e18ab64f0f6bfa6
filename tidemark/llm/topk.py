"""Operator 12: exact top-k search by a Voronoi join.

Inner products become distances by one more component: a candidate x gets sqrt(M^2 - |x|^2), M the greatest length, a query
0; then |q - x|^2 = |q|^2 + M^2 - 2 <q, x>, so the k best scores are the k nearest. Pivots (centers of a bounded sample) split
queries and candidates into cells; candidates are cut into blocks by their distance to the pivot, rings of the cell.

From summaries alone (each block's least and greatest distance to its pivot, the few least of each cell, the distances between
pivots) follow a radius that holds the k nearest of every query of a block, and the least distance between two blocks. A ring
goes to the query blocks whose radius reaches it, no others. There the scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common, vectors

#: Queries of a cell, about; more pivots than ``vectors.CELLS`` are not made.
QUERIES_EACH = 128

_FOUND = "query_row long, query_id long, score long, vec_id long, row long"


def _cells(table: vectors.Table, rows: DataFrame, pivots: np.ndarray, most: float, asking: bool) -> DataFrame:
    """With the cell and the distance to its pivot as ``place``."""
    width, kind = table.width, table.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.frombuffer(b"".join(b.column("mat").to_pylist()), kind).reshape(b.num_rows, width).astype(np.float64)
            more = np.zeros(len(x)) if asking else np.sqrt(np.maximum(most * most - (x * x).sum(axis=1), 0))
            d = vectors.distances(np.column_stack([x, more]), pivots)
            cell = d.argmin(axis=1)
            cols = [b.column(c) for c in ("row", "vec_id", "label", "mat")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(x)), cell])], ["row", "vec_id", "label", "mat", "cell", "place"])

    return rows.select("row", "vec_id", "label", "mat").mapInArrow(run, "row long, vec_id long, label long, mat binary, cell int, place double")


def reached(asking: DataFrame, held: DataFrame, pivots: np.ndarray, k: int, slack: float) -> DataFrame:
    """Pairs (a, c) of query and candidate blocks that the radius doesn't rule out."""
    spark = asking.sparkSession
    # the first block of a cell has its least distances, k + 1 as a query's own row may be among them
    least = {r["cell"]: r["least"] for r in held.groupBy("cell").agg(F.min_by("least", "lo").alias("least")).collect()}  # cells are bounded
    apart = vectors.distances(pivots, pivots)
    radius = []
    for i in range(len(pivots)):
        near = np.sort(np.concatenate([[np.inf] * (k + 1), *(apart[i, j] + np.array(d) for j, d in least.items())]))
        radius.append(float(near[k]))
    cells = [(i, j, float(apart[i, j]), radius[i]) for i in range(len(pivots)) for j in least]
    cells = spark.createDataFrame(cells, "i int, j int, apart double, radius double")
    a = asking.select(F.col("block").alias("a"), F.col("cell").alias("i"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"))
    c = held.select(F.col("block").alias("c"), F.col("cell").alias("j"), F.col("lo").alias("c_lo"), F.col("hi").alias("c_hi"))
    between = F.greatest(F.col("apart") - F.col("a_hi") - F.col("c_hi"), F.col("c_lo") - F.col("a_hi") - F.col("apart"), F.col("a_lo") - F.col("c_hi") - F.col("apart"))
    near = a.join(F.broadcast(cells), "i").join(c, "j").where(between <= F.col("a_hi") + F.col("radius") + F.lit(slack))
    return near.select("a", "c")


def search(vectors_df: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``queries`` (a condition on vec_id) selects, the k rows of highest
    inner product among all rows but itself, ties to the smaller id.

    See ``vectors.Table`` for rows that take no part, vectors of unequal length and repeated ids (a repeated query id has
    its ranks once for each of its rows). Scores past 64 bits are held at the ends of the range. Fewer than k other rows:
    all of them. Empty table, or no query: no rows. Only the two named columns are read.

    Pivots: one for ``QUERIES_EACH`` queries, ``vectors.CELLS`` at most, fitted on ``vectors.SAMPLE`` rows; every row is
    searched. Where vectors don't cluster, as random ones of many components, no ring can be ruled out, and each block of
    queries meets each block of candidates; a query that no vector of the block can serve is then left out by the block's
    own bound.
    """
    table = vectors.Table(vectors_df, id_col, vec_col)
    asked = table.rows.where(queries)
    found = table.rows.agg(F.max("norm").alias("most"), F.count_if(queries).alias("asked")).first()
    most, count = found["most"] or 0.0, found["asked"]
    sample = table.sample(table.rows)
    if not len(sample):
        sample = np.zeros((1, table.width))
    more = np.sqrt(np.maximum(most * most - (sample * sample).sum(axis=1), 0))
    pivots = vectors.centers_of(np.column_stack([sample, more]), max(1, min(vectors.CELLS, count // QUERIES_EACH)))
    held = vectors.blocks(table, _cells(table, table.rows, pivots, most, asking=False), vectors.BLOCK, "rings", least=k + 1)
    asking = vectors.blocks(table, _cells(table, asked, pivots, most, asking=True), vectors.BLOCK, "queries")
    # scores held at the end of their range tie, so there distances decide nothing
    pairs = reached(asking, held, pivots, k, slack=1e-6 * (most + 1) if most * most < 1 << 62 else float("inf"))

    def begin(block, batch, i):
        return block, vectors.Best(len(block.ids), k)

    def step(state, block):
        own, best = state
        rows = best.open(vectors.bounds(own.mat, own.norms, block))
        if len(rows):
            score = vectors.products(own.mat[rows], block.mat)
            score[own.rows[rows][:, None] == block.rows[None]] = vectors.NONE
            best.add(rows, score, block)

    def result(state):
        own, best = state
        r, c = np.nonzero(best.score != vectors.NONE)
        cols = [own.rows[r], own.ids[r], best.score[r, c], best.id[r, c], best.row[r, c]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["query_row", "query_id", "score", "vec_id", "row"])

    got = vectors.solve(vectors.met(pairs, asking, held), table, _FOUND, begin, step, result)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return got.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


_GOOD = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
_WHOLE = "list_transform(embedding, lambda x: floor(256 * x::double))"
#: The same in SQL; sums of whole numbers are exact.
ORACLE = f"""with v as (select vec_id, {_WHOLE} as x from embeddings where {_GOOD}),
 s as (select q.vec_id as query_id, v.vec_id, list_inner_product(q.x, v.x)::bigint as score from v q join v on q.vec_id <> v.vec_id where q.vec_id % 50 = 0),
 r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
 select query_id, rank, vec_id, score from r where rank <= 5"""
