"""Operator 13: hard negatives by dual-tree search.

Anchors and candidates each have a tree: the root splits into nodes by centers of a bounded sample, a node into cells, a cell
into leaf blocks of bounded size, apart by label as far as rows allow. Two balls (center, radius) give an interval that holds
every inner product of an anchor of one with a candidate of the other:

    <a, c>  -/+  (|a| rc + |c| ra + ra rc).

The trees are descended together. At each level a pair of nodes is dropped for all its anchors at once when its interval
cannot matter: for positives, when enough candidates of the label surely score higher; for negatives, when it misses all the
anchors' windows, or when enough candidates that are surely in every window's reach score higher. Pairs of leaves that are
left are scored in exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common, vectors

#: Children of the root, and of each of its nodes.
FAN = 16
#: Anchors that a node is made for, about, so that few anchors make few nodes.
ANCHORS_EACH, CANDIDATES_EACH = 64, 2048
ANCHOR_BLOCK = 256
#: Share of |a| |c| and whole part by which an interval is widened, for what rounding may have cost.
SLACK = 1e-9

_POSITIVE = "block long, anchor_row long, anchor_id long, label long, score long, vec_id long, row long"
_NEGATIVE = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long, score long, vec_id long, row long"


def tree(sample: np.ndarray, most: int) -> np.ndarray:
    """Centers of the tree's cells: children of the root's children."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    top = vectors.centers_of(sample, max(1, min(FAN, round(most**0.5))))
    near = vectors.distances(sample, top).argmin(axis=1)
    return np.concatenate([vectors.centers_of(sample[near == i], max(1, min(FAN, most // len(top)))) for i in np.unique(near)])


def _cells(table: vectors.Table, rows: DataFrame, centers: np.ndarray) -> DataFrame:
    """With the nearest cell, and as ``place`` the coordinate along the line from the origin through the center."""
    width, kind, norm = table.width, table.kind, np.maximum(vectors.lengths(centers), 1e-9)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.frombuffer(b"".join(b.column("mat").to_pylist()), kind).reshape(b.num_rows, width).astype(np.float64)
            cell = vectors.distances(x, centers).argmin(axis=1)
            place = (x * (centers[cell] / norm[cell][:, None])).sum(axis=1)
            cols = [b.column(c) for c in ("row", "vec_id", "label", "mat")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(cell.astype(np.int32)), pa.array(place)], ["row", "vec_id", "label", "mat", "cell", "place"])

    return rows.select("row", "vec_id", "label", "mat").mapInArrow(run, "row long, vec_id long, label long, mat binary, cell int, place double")


def _held(x: np.ndarray) -> np.ndarray:
    """Within the range of scores, which end there."""
    return np.clip(x, float(vectors.NONE), -float(vectors.NONE))


def intervals(pairs: DataFrame) -> DataFrame:
    """``low`` and ``high`` of each pair of balls (a_center, a_radius), (c_center, c_radius) in place of these."""
    keep = [f for f in pairs.schema.fields if f.name not in ("a_center", "c_center", "a_radius", "c_radius")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            a, c = (np.frombuffer(b"".join(b.column(f"{p}_center").to_pylist()), "<f8").reshape(b.num_rows, -1) for p in "ac")
            ra, rc = (b.column(f"{p}_radius").to_numpy() for p in "ac")
            na, nc = vectors.lengths(a), vectors.lengths(c)
            mid, wide = (a * c).sum(axis=1), na * rc + nc * ra + ra * rc
            wide += SLACK * (na + ra) * (nc + rc) + 1
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in keep], pa.array(_held(mid - wide)), pa.array(_held(mid + wide))], [*[f.name for f in keep], "low", "high"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep)
    return pairs.mapInArrow(run, f"{schema}, low double, high double")


def _enough(keys: list[str], counts: Column, needed: int) -> Column:
    """The greatest bound that ``needed`` rows of the group surely reach; null if none."""
    so_far = F.sum(counts).over(Window.partitionBy(*keys).orderBy(F.desc("low"), "c").rowsBetween(Window.unboundedPreceding, 0))
    return F.when(so_far >= needed, F.col("low")).alias("reached")


def _unbeaten(pairs: DataFrame, keys: list[str], counts: Column, needed: int) -> DataFrame:
    """Pairs that are not surely beaten by ``needed`` rows of their group."""
    sure = pairs.withColumn("reached", _enough(keys, counts, needed))
    sure = sure.withColumn("cut", F.max("reached").over(Window.partitionBy(*keys)))
    return sure.where(F.col("cut").isNull() | (F.col("high") >= F.col("cut"))).drop("reached", "cut")


def parts(blocks: DataFrame) -> DataFrame:
    """block, cell, label, n, center, radius: one label of one block."""
    return blocks.select("block", "cell", F.explode("parts").alias("p")).select("block", "cell", "p.label", "p.n", "p.center", "p.radius")


def nodes(blocks: DataFrame, centers: np.ndarray, labelled: bool) -> DataFrame:
    """Balls of cells (of cell and label, if labelled): the cell's center, a radius that covers its blocks' balls, n."""
    rows = parts(blocks)
    of = spark_centers(rows.sparkSession, centers)
    rows = rows.join(F.broadcast(of), "cell")  # cells are bounded
    keys = ["cell", "label"] if labelled else ["cell"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            a, c = (np.frombuffer(b"".join(b.column(k).to_pylist()), "<f8").reshape(b.num_rows, -1) for k in ("middle", "center"))
            reach = vectors.lengths(a - c) * (1 + 1e-9) + b.column("radius").to_numpy() + 1e-6
            yield pa.RecordBatch.from_arrays([b.column("cell"), b.column("label"), b.column("n"), pa.array(reach)], ["cell", "label", "n", "radius"])

    reach = rows.select("cell", "label", "n", "middle", "center", "radius").mapInArrow(run, "cell int, label long, n long, radius double")
    return reach.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).join(F.broadcast(of), "cell").withColumnRenamed("middle", "center")


def spark_centers(spark: SparkSession, centers: np.ndarray) -> DataFrame:
    return spark.createDataFrame([(i, c.astype("<f8").tobytes()) for i, c in enumerate(centers)], "cell int, middle binary")


def _ball(df: DataFrame, p: str, **names: str) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in names.items()], F.col("center").alias(f"{p}_center"), F.col("radius").alias(f"{p}_radius"))


def positives(asking: DataFrame, held: DataFrame, a_centers: np.ndarray, c_centers: np.ndarray, table: vectors.Table, k: int) -> DataFrame:
    """Each anchor's best k rows of its label but itself, with the block of the anchor."""
    a = _ball(nodes(asking, a_centers, True), "a", cell="i", label="label")
    c = _ball(nodes(held, c_centers, True), "c", cell="c", label="label", n="n")
    over = _unbeaten(intervals(a.join(c, "label")), ["i", "label"], F.col("n"), k + 1).select("label", "i", F.col("c").alias("j"))
    a = _ball(parts(asking), "a", block="a", cell="i", label="label")
    c = _ball(parts(held), "c", block="c", cell="j", label="label", n="n")
    leaves = intervals(over.join(a, ["label", "i"]).join(c, ["label", "j"]).drop("i", "j"))
    pairs = _unbeaten(leaves, ["a", "label"], F.col("n"), k + 1).select("a", "c").distinct()

    def begin(block, batch, i):
        return block, vectors.Best(len(block.ids), k), batch.column("a")[i].as_py()

    def step(state, block):
        own, best, _ = state
        rows = best.open(vectors.bounds(own.mat, own.norms, block))
        if len(rows):
            score = vectors.products(own.mat[rows], block.mat)
            score[(own.labels[rows][:, None] != block.labels[None]) | (own.rows[rows][:, None] == block.rows[None])] = vectors.NONE
            best.add(rows, score, block)

    def result(state):
        own, best, name = state
        r, c = np.nonzero(best.score != vectors.NONE)
        cols = [np.full(len(r), name), own.rows[r], own.ids[r], own.labels[r], best.score[r, c], best.id[r, c], best.row[r, c]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["block", "anchor_row", "anchor_id", "label", "score", "vec_id", "row"])

    got = vectors.solve(vectors.met(pairs, asking, held), table, _POSITIVE, begin, step, result)
    rank = F.row_number().over(Window.partitionBy("anchor_row").orderBy(F.desc("score"), "vec_id", "row"))
    return got.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def windows(found: DataFrame, least: int, most: int) -> DataFrame:
    """With lo and hi, the least and greatest score of a negative; positives whose window holds no whole number go."""
    score = F.col("score").cast("decimal(20,0)")
    percent = lambda p, up: (f"cast(({p} * cast(score as decimal(20,0)) + {99 if up else 0}) div 100 as bigint)")
    # a negative score has an empty window, as least < most
    return found.where(score >= 0).withColumns({"lo": F.expr(percent(least, True)), "hi": F.expr(percent(most, False))}).where("lo <= hi")


def negatives(
    wanted: DataFrame, asking: DataFrame, held: DataFrame, a_centers: np.ndarray, c_centers: np.ndarray, table: vectors.Table, k: int
) -> DataFrame:
    """For each anchor and positive of ``wanted`` (with lo and hi), the best k rows of other labels in the window."""
    spark = wanted.sparkSession
    reach = [F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("hi").alias("low_hi")]
    groups = wanted.groupBy(F.col("block").alias("a"), "label").agg(*reach)
    leaf = parts(asking).withColumnRenamed("block", "a").join(groups, ["a", "label"])
    tops = leaf.groupBy("cell", "label").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("low_hi").alias("low_hi"))
    a = nodes(asking, a_centers, True).join(tops, ["cell", "label"])
    a = a.select(F.col("cell").alias("i"), "label", "lo", "hi", "low_hi", F.col("center").alias("a_center"), F.col("radius").alias("a_radius"))
    # every pair of cells is named, at most vectors.CELLS squared
    grid = spark.createDataFrame([(i, j) for i in range(len(a_centers)) for j in range(len(c_centers))], "i int, c int")
    c = _ball(nodes(held, c_centers, False), "c", cell="c", n="n")
    same = nodes(held, c_centers, True).select(F.col("cell").alias("c"), "label", F.col("n").alias("own"))

    def left(pairs: DataFrame, keys: list[str], others: Column) -> DataFrame:
        """Pairs that reach a window and are not beaten by k rows that every window of the group reaches."""
        pairs = pairs.where((F.col("high") >= F.col("lo")) & (F.col("low") <= F.col("hi")) & (others > 0))
        sure = F.when((F.col("high") <= F.col("low_hi")), others).otherwise(0)
        return _unbeaten(pairs, keys, sure, k)

    top = intervals(a.join(F.broadcast(grid), "i").join(F.broadcast(c), "c")).join(same, ["c", "label"], "left").fillna(0, ["own"])
    top = left(top, ["i", "label"], F.col("n") - F.col("own")).select("i", "label", F.col("c").alias("j"))
    a = leaf.select("a", F.col("cell").alias("i"), "label", "lo", "hi", "low_hi", F.col("center").alias("a_center"), F.col("radius").alias("a_radius"))
    c = held.select(F.col("block").alias("c"), F.col("cell").alias("j"), "n", "parts", F.col("center").alias("c_center"), F.col("radius").alias("c_radius"))
    own = F.coalesce(F.expr("aggregate(parts, cast(0 as bigint), (s, p) -> s + if(p.label = label, p.n, cast(0 as bigint)))"), F.lit(0))
    leaves = top.join(a, ["i", "label"]).join(c, "j").withColumn("others", F.col("n") - own).drop("i", "j", "n", "parts")
    pairs = left(intervals(leaves), ["a", "label"], F.col("others")).select("a", "c").distinct()
    # an anchor has a handful of positives, a block a few hundred anchors
    asked = wanted.groupBy(F.col("block").alias("a")).agg(F.sort_array(F.collect_list(F.struct("anchor_row", "row", "vec_id", "score", "lo", "hi"))).alias("windows"))

    def begin(block, batch, i):
        w = batch.column("windows")[i].values
        w = {f.name: w.field(f.name).to_numpy() for f in w.type}
        order = np.argsort(block.rows)
        at = order[np.searchsorted(block.rows[order], w["anchor_row"])]
        return block, vectors.Best(len(at), k), w, at

    def step(state, block):
        own, best, w, at = state
        upper = vectors.bounds(own.mat, own.norms, block)[at]
        rows = best.open(upper)
        rows = rows[upper[rows] >= w["lo"][rows]]
        if not len(rows):
            return
        anchors, of = np.unique(at[rows], return_inverse=True)
        every = vectors.products(own.mat[anchors], block.mat)
        every[own.labels[anchors][:, None] == block.labels[None]] = vectors.NONE
        score = every[of]
        score[(score < w["lo"][rows][:, None]) | (score > w["hi"][rows][:, None])] = vectors.NONE
        best.add(rows, score, block)

    def result(state):
        own, best, w, at = state
        r, c = np.nonzero(best.score != vectors.NONE)
        cols = [w["anchor_row"][r], own.ids[at[r]], w["row"][r], w["vec_id"][r], w["score"][r], best.score[r, c], best.id[r, c], best.row[r, c]]
        names = ["anchor_row", "anchor_id", "positive_row", "positive_id", "positive_score", "score", "vec_id", "row"]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names)

    got = vectors.solve(vectors.met(pairs, asking, held, asked), table, _NEGATIVE, begin, step, result)
    rank = F.row_number().over(Window.partitionBy("anchor_row", "positive_row").orderBy(F.desc("score"), "vec_id", "row"))
    return got.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(
    vectors_df: DataFrame, anchors: Column, *, positive: int = 5, negative: int = 10, least: int = 30, most: int = 90,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row that ``anchors`` (a condition
    on vec_id) selects and each of its ``positive`` best other rows of the same label, the ``negative`` best rows of other
    labels that score ``least`` to ``most`` percent of the positive. Fewer rows: all of them; ties to the smaller id.

    Rows with a null label take no part; see ``vectors.Table`` for nulls, unequal lengths, repeated ids and scores past 64
    bits. A positive of negative score has an empty window and no rows, one of score 0 a window of 0 alone. Labels are whole
    numbers; however many there are, a block holds several. Empty table, or no anchor: no rows. Only the named columns are
    read. Centers are fitted on ``vectors.SAMPLE`` rows of either tree; every row is searched.
    """
    table = vectors.Table(vectors_df, id_col, vec_col, label_col)
    asked = table.rows.where(anchors)
    a_centers, c_centers = (
        tree(table.sample(rows), max(1, min(vectors.CELLS, rows.count() // each))) for rows, each in ((asked, ANCHORS_EACH), (table.rows, CANDIDATES_EACH))
    )
    held = vectors.blocks(table, _cells(table, table.rows, c_centers), vectors.BLOCK, "candidates")
    asking = vectors.blocks(table, _cells(table, asked, a_centers), ANCHOR_BLOCK, "anchors")
    found = common.stored(positives(asking, held, a_centers, c_centers, table, positive), "positives")
    got = negatives(windows(found, least, most), asking, held, a_centers, c_centers, table, negative)
    return got.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return mine(rows, F.col("vec_id") % 100 == 0)


_GOOD = "label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
#: The same in SQL; sums of whole numbers are exact.
ORACLE = f"""with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as x from embeddings where {_GOOD}),
 s as (select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_inner_product(a.x, c.x)::bigint as score from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0),
 p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
 n as (select p.*, s.vec_id as negative_id, s.score as negative_score, row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)::int as rank
   from p join s on p.anchor_id = s.anchor_id and not s.same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
 select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10"""
