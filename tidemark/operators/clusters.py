"""Clots (greedy complete-linkage neighbourhoods), their binding and weights; density clustering of sources."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.graph import components
from tidemark.scratch import stored

#: Points whose spanning forests are finished in one task for each least number; more take connected components.
MOST_FOREST = 200_000

#: Distances (20 bytes each, and their objects' names) that a block of seeds is sent, at most, on average.
CLOT_CELLS = 2_000_000


def both_ways(distances: DataFrame) -> DataFrame:
    """a, b, distance in both directions, and each object with itself at 0."""
    back = distances.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance")
    own = distances.select("a").union(distances.select("b")).distinct().select("a", F.col("a").alias("b"), F.lit(0.0).alias("distance"))
    return distances.select("a", "b", "distance").unionByName(back).unionByName(own)


def neighbourhoods(distances: DataFrame, radius: float) -> DataFrame:
    """seed, members (sorted): objects within ``radius`` of each."""
    return both_ways(distances).where(F.col("distance") <= radius).groupBy(F.col("a").alias("seed")).agg(F.array_sort(F.collect_set("b")).alias("members"))


def grow(dm: np.ndarray, d1: float, start: int) -> list[int]:
    """Add the candidate with the least total distance to the members, the first of equals, while all stay within d1 of each
    other. Totals and candidates are carried along, so that a step costs one row of the matrix."""
    inside, total, fits, last = [], np.zeros(len(dm)), np.ones(len(dm), bool), start
    while True:
        inside.append(last)
        total += dm[last]
        fits &= dm[last] <= d1
        fits[last] = False
        if not fits.any():
            return inside
        rest = np.flatnonzero(fits)
        last = int(rest[np.argmin(total[rest])])


def _clots_of(d1: float, medoid: bool):
    """Cogroup of a block's neighbourhoods (seed, x) and the distance lists of their objects (x, b, distance)."""

    def run(near: pa.Table, lists: pa.Table) -> pa.Table:
        each = lists["adjacent"].combine_chunks()
        width = np.diff(each.offsets.to_numpy())
        flat = each.flatten()
        strings = lambda c: np.array(c.to_pylist(), object)
        x, b, d = strings(lists["x"]), strings(flat.field("b")), flat.field("distance").to_numpy()
        names, code = np.unique(np.concatenate([x, b]), return_inverse=True)
        row_of = np.full(len(names), -1)
        row_of[code[: len(x)]] = np.arange(len(x))
        ends, cols = np.append(0, np.cumsum(width)), code[len(x) :]
        at = dict(zip(names, range(len(names)), strict=True))
        hoods: dict[str, list[int]] = {}
        for s, m in zip(near["seed"].to_pylist(), near["x"].to_pylist(), strict=True):
            hoods.setdefault(s, []).append(at[m])
        place, seeds, found = np.full(len(names), -1), [], []
        for s, hood in hoods.items():
            members = np.unique(hood)
            n = len(members)
            place[members] = np.arange(n)
            dm = np.ones((n, n))
            for i, r in enumerate(row_of[members]):
                local = place[cols[ends[r] : ends[r + 1]]]
                dm[i, local[local >= 0]] = d[ends[r] : ends[r + 1]][local >= 0]
            place[members] = -1
            start = int(np.argmin(dm.sum(axis=0))) if medoid else int(np.searchsorted(members, at[s]))
            seeds.append(s)
            found.append(sorted(names[members[grow(dm, d1, start)]]))
        return pa.table({"seed": pa.array(seeds, pa.string()), "members": pa.array(found, pa.list_(pa.string()))})

    return run


def clots(distances: DataFrame, d1: float, d2: float, medoid: bool = True) -> DataFrame:
    """seed, members: the clot grown inside each object's neighbourhood (objects within d2, itself included), from its medoid,
    the first by name of equals, or from the object. Pairs that are not listed are at distance 1; each pair is listed once.
    d2 is under 1, an error otherwise: from 1 on every object's neighbourhood would be all objects.

    Objects send their list of distances once to each block of seeds that has them in a neighbourhood; blocks are as many as
    hold ``CLOT_CELLS`` distances on average, each list counted for each seed. A task holds a block's lists, and the square
    matrix of one neighbourhood at a time. Rows with null a, b or distance are passed over; an empty table has no clots.
    """
    if d2 >= 1:
        raise ValueError(f"d2 must be under 1, the distance of pairs that are not listed: {d2}")
    known = stored(both_ways(distances.where("a is not null and b is not null and distance is not null")), "both_ways")
    lists = known.groupBy(F.col("a").alias("x")).agg(F.collect_list(F.struct("b", F.col("distance").cast("double").alias("distance"))).alias("adjacent"))
    near = known.where(F.col("distance") <= d2).select(F.col("a").alias("seed"), F.col("b").alias("x"))
    degree = known.groupBy(F.col("a").alias("x")).agg(F.count("*").alias("n"))
    cells = near.join(degree, "x").agg(F.sum("n")).first()[0] or 0
    near = near.withColumn("block", F.pmod(F.xxhash64("seed"), F.lit(-(-cells // CLOT_CELLS) or 1)))
    sent = near.select("block", "x").distinct().join(lists, "x").toDF("x", "to", "adjacent")
    return near.groupBy("block").cogroup(sent.groupBy("to")).applyInArrow(_clots_of(d1, medoid), "seed string, members array<string>")


def unique(found: DataFrame, least: int = 1) -> DataFrame:
    """Distinct member sets of ``least`` or more, with an id."""
    x = found.where(F.size("members") >= least).select("members").distinct()
    return x.select(F.xxhash64(F.array_join("members", "\x1f")).alias("clot"), "members")


def bind(sets: DataFrame, d3: float) -> DataFrame:
    """cluster, member: union of clots linked by overlap distance under d3, transitively. Pairs come from shared members."""
    x = sets.select("clot", F.explode("members").alias("member"), F.size("members").alias("n"))
    a, b = x.toDF("u", "member", "nu"), x.toDF("v", "member", "nv")
    edges = a.join(b, "member").where("u < v").groupBy("u", "v").agg(F.count("*").alias("both"), F.least(F.first("nu"), F.first("nv")).alias("least"))
    linked = components(edges.where(1 - F.col("both") / F.col("least") < d3).select("u", "v"))
    y = x.join(linked.toDF("clot", "cluster"), "clot", "left").select(F.coalesce("cluster", "clot").alias("c"), "member").distinct()
    named = y.groupBy("c").agg(F.min("member").alias("first"), F.array_join(F.array_sort(F.collect_set("member")), " ").alias("key"))
    return y.join(named, "c").select(F.col("key").alias("cluster"), "member")


def weights(clusters: DataFrame, cells: DataFrame, inverse: bool, full: bool = False) -> DataFrame:
    """cluster, object, weight by the sum of cells (a, b, v) between the object and the cluster's members: 1 - s / max for
    distances, s / max for frequencies; a cluster whose sums are all 0 has weights 1 or 0. ``full``: all objects, not only
    members."""
    s = clusters.select("cluster", F.col("member").alias("b")).join(cells, "b").groupBy("cluster", F.col("a").alias("object")).agg(F.sum("v").alias("s"))
    if not full:
        s = clusters.select("cluster", F.col("member").alias("object")).join(s, ["cluster", "object"], "left").withColumn("s", F.coalesce("s", F.lit(0.0)))
    top = F.max("s").over(Window.partitionBy("cluster"))
    share = F.when(top > 0, F.col("s") / top).otherwise(0.0)
    return s.select("cluster", "object", (1 - share if inverse else share).alias("weight"))


def cluster_weights(objects: DataFrame) -> DataFrame:
    """Mean object weight of each cluster."""
    return objects.groupBy("cluster").agg(F.avg("weight").alias("weight"), F.count("*").alias("n"))


def key_objects(all_weights: DataFrame, clusters: DataFrame, n: int) -> DataFrame:
    """The n heaviest objects inside each cluster (kind ``key``) and outside it (``extra``), ties by name."""
    inside = clusters.select("cluster", F.col("member").alias("object"), F.lit(True).alias("inside"))
    x = all_weights.join(inside, ["cluster", "object"], "left").withColumn("kind", F.when(F.col("inside"), "key").otherwise("extra"))
    rank = F.row_number().over(Window.partitionBy("cluster", "kind").orderBy(F.desc("weight"), "object"))
    return x.withColumn("rank", rank).where(F.col("rank") <= n).select("cluster", "kind", "object", "rank", "weight")


def dbscan_grid(distances: DataFrame, points: DataFrame, grid: list[tuple[float, int]], unlisted: float | None = None) -> DataFrame:
    """cell, point, label of density clusterings for each (eps, least points) of ``grid``, all at once.

    ``distances``: a < b, distance (at most the greatest eps are needed); ``points``: point, a long of 40 bits at most, and
    perhaps weight: how many points at one place it stands for (see ``equal_rows``; null is 1).
    Label -1 is noise; clusters count from 0 by their least core point; a border point joins the lowest. Points without a
    listed distance are alone; empty tables: no rows. ``unlisted``: no pair is farther apart than this, listed or not, so
    that from this eps on all points are neighbours.
    """
    points = _weighed(points)
    if unlisted is not None and any(e >= unlisted for e, _ in grid):
        return _grid_with_all(distances, points, grid, unlisted)
    if points.count() <= MOST_FOREST:
        return _grid_by_forests(distances, points, grid)
    return _grid_by_components(distances, points, grid)


def _weighed(points: DataFrame) -> DataFrame:
    weight = F.coalesce("weight", F.lit(1)).cast("long") if "weight" in points.columns else F.lit(1).cast("long")
    return points.select("point", weight.alias("weight")).dropDuplicates(["point"])


def equal_rows(sparse: DataFrame) -> DataFrame:
    """row, point of sparse vectors (row, col, v): the least of the rows whose vectors are the same but for a factor. Such
    rows have the same distances to all others, so that only points need to be compared. Rows without a value over 0 have
    none."""
    cells = sparse.where("row is not null and col is not null and v is not null").groupBy("row", "col").agg(F.sum(F.col("v").cast("double")).alias("v")).where("v <> 0")
    vec = cells.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("col", "v"))).alias("vec"), F.max(F.abs("v")).alias("top"))
    vec = stored(vec.select("row", F.transform("vec", lambda x: F.struct(x["col"].alias("col"), (x["v"] / F.col("top")).alias("v"))).alias("vec")), "shapes")
    return vec.join(vec.groupBy("vec").agg(F.min("row").alias("point")), "vec").select("row", "point")


def _grid_with_all(distances: DataFrame, points: DataFrame, grid: list[tuple[float, int]], unlisted: float) -> DataFrame:
    """Cells of eps under ``unlisted``, and the others: one cluster of all points if they are enough, else noise."""
    spark = points.sparkSession
    some = [(i, c) for i, c in enumerate(grid) if c[0] < unlisted]
    number = F.broadcast(spark.createDataFrame([(j, i) for j, (i, _) in enumerate(some)], "cell int, own int"))
    out = dbscan_grid(distances, points, [c for _, c in some]).join(number, "cell").select(F.col("own").alias("cell"), "point", "label")
    rest = spark.createDataFrame([(i, n) for i, (e, n) in enumerate(grid) if e >= unlisted], "cell int, least int")
    total = points.agg(F.sum("weight").alias("total"))
    every = points.select("point").crossJoin(F.broadcast(rest)).crossJoin(F.broadcast(total))
    return out.unionByName(every.select("cell", "point", F.when(F.col("total") >= F.col("least"), 0).otherwise(-1).alias("label")))


def _forest(w: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (numbers in ``order``) of a least spanning forest, nodes, and each node's root after every kept edge's union."""
    nodes, at = np.unique(np.append(a, b), return_inverse=True)
    parent, kept = list(range(len(nodes))), []
    left, right, order = at[: len(a)].tolist(), at[len(a) :].tolist(), np.argsort(w, kind="stable")
    for k in order.tolist():
        x, y = left[k], right[k]
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(k)
            if len(kept) == len(nodes) - 1:
                break
    return np.array(kept, np.int64), nodes, at


def _local_forests(steps: int):
    """Of a task's edges (a, b, e, ca, cb), for each least number k the forest by w, the first step at which the edge joins
    two core points. What a forest leaves out joins nothing that the forest doesn't."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}

        def thin(k: int) -> None:
            w, a, b = held[k]
            keep = _forest(w, a, b)[0]
            held[k] = [w[keep], a[keep], b[keep]]

        for x in batches:
            if not x.num_rows:
                continue
            a, b, e = (x.column(c).to_numpy() for c in ("a", "b", "e"))
            ca, cb = (x.column(c).flatten().to_numpy().reshape(x.num_rows, -1) for c in ("ca", "cb"))
            for k in range(ca.shape[1]):
                w = np.maximum(np.maximum(ca[:, k], cb[:, k]), e)
                ok = w < steps
                old = held.get(k, [np.zeros(0, w.dtype), a[:0], b[:0]])
                held[k] = [np.append(o, n[ok]) for o, n in zip(old, (w, a, b), strict=True)]
                thin(k)
        for k, (w, a, b) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), k, np.int32)), pa.array(w.astype(np.int32)), pa.array(a), pa.array(b)], ["k", "w", "a", "b"])

    return run


def _roots(steps: int):
    """k, i, point, root: of each step the nodes with an edge of at most that step, and their least node."""

    def run(t: pa.Table) -> pa.Table:
        w, a, b = (t[c].to_numpy() for c in ("w", "a", "b"))
        keep, nodes, at = _forest(w, a, b)
        left, right, w = at[: len(a)][keep], at[len(a) :][keep], w[keep]
        root, seen, out, done = np.arange(len(nodes)), np.zeros(len(nodes), bool), [], 0
        for i in range(steps):
            upto = int(np.searchsorted(w, i, "right"))
            for x, y in zip(left[done:upto].tolist(), right[done:upto].tolist(), strict=True):
                while root[x] != x:
                    root[x] = x = root[root[x]]
                while root[y] != y:
                    root[y] = y = root[root[y]]
                root[max(x, y)] = min(x, y)
            seen[left[done:upto]] = seen[right[done:upto]] = True
            done = upto
            while (root != root[root]).any():
                root = root[root]
            n = np.flatnonzero(seen)
            out.append((np.full(len(n), i, np.int32), nodes[n], nodes[root[n]]))
        i, point, top = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"k": pa.array(np.full(len(i), t["k"][0].as_py(), np.int32)), "i": i, "point": point, "root": top})

    return run


def _grid_by_forests(distances: DataFrame, points: DataFrame, grid: list[tuple[float, int]]) -> DataFrame:
    """A point is core at step i of eps if it has enough neighbours; an edge joins two core points from step w on, the
    greatest of its own step and its ends' first core steps. So for each least number one spanning forest by w has the
    clusters of every eps, and the pairs are read a few times whatever the number of cells."""
    spark = points.sparkSession
    eps, leasts = sorted({float(e) for e, _ in grid}), sorted({n for _, n in grid})
    steps = len(eps)
    step = sum(((F.col("distance") > e).cast("int") for e in eps), F.lit(0))
    pairs = stored(distances.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), step.alias("e")).where(F.col("e") < steps), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "e"))
    points = stored(points.select(F.col("point").cast("long").alias("point"), "weight"), "weighed")
    near = both.join(points.toDF("b", "weight"), "b").groupBy(F.col("a").alias("point"))
    n = near.agg(*[F.sum(F.when(F.col("e") <= i, F.col("weight")).otherwise(0)).alias(f"n{i}") for i in range(steps)])
    every = points.join(n, "point", "left").fillna(0)

    def first_step(least: int):
        out = F.lit(steps)
        for i in reversed(range(steps)):
            out = F.when(F.col(f"n{i}") + F.col("weight") >= least, i).otherwise(out)
        return out

    every = stored(every.select("point", F.array(*map(first_step, leasts)).alias("core")), "points")
    edges = pairs.join(every.toDF("a", "ca"), "a").join(every.toDF("b", "cb"), "b")
    forests = edges.mapInArrow(_local_forests(steps), "k int, w int, a long, b long")
    roots = forests.groupBy("k").applyInArrow(_roots(steps), "k int, i int, point long, root long")
    spread = every.select("point", F.posexplode("core").alias("k", "c")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    cores = spread.where("c <= i").join(roots, ["k", "i", "point"], "left").select("k", "i", "point", F.coalesce("root", "point").alias("root"))
    cores = stored(cores.select("k", "i", "point", (F.dense_rank().over(Window.partitionBy("k", "i").orderBy("root")) - 1).alias("label")), "cores")
    # a point that is not core has fewer neighbours than the greatest least number
    near = both.join(every.select(F.col("point").alias("a"), F.posexplode("core").alias("k", "c")), "a")
    near = near.where(F.col("c") > F.col("e")).withColumn("i", F.explode(F.expr("sequence(e, c - 1)")))
    border = near.join(cores.withColumnRenamed("point", "b"), ["k", "i", "b"]).groupBy("k", "i", F.col("a").alias("point")).agg(F.min("label").alias("near"))
    cells = spark.createDataFrame([(j, eps.index(float(e)), leasts.index(n)) for j, (e, n) in enumerate(grid)], "cell int, i int, k int")
    out = every.select("point").crossJoin(F.broadcast(cells)).join(cores, ["k", "i", "point"], "left").join(border, ["k", "i", "point"], "left")
    return out.select("cell", "point", F.coalesce("label", "near", F.lit(-1)).alias("label"))


def _grid_by_components(distances: DataFrame, points: DataFrame, grid: list[tuple[float, int]]) -> DataFrame:
    spark, cells = points.sparkSession, len(grid)
    params = F.broadcast(spark.createDataFrame([(i, float(e), n) for i, (e, n) in enumerate(grid)], "cell int, eps double, least int"))
    node = lambda c: F.col(c) * cells + F.col("cell")
    near = distances.crossJoin(params).where("distance <= eps").select("cell", "least", node("a").alias("a"), node("b").alias("b"))
    every = points.crossJoin(params).select("cell", "least", "point", "weight", node("point").alias("node"))
    both = near.select("least", "a", "b").unionByName(near.select("least", F.col("b").alias("a"), F.col("a").alias("b")))
    around = both.join(every.select(F.col("node").alias("b"), "weight"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("n"))
    core = every.join(around, "node", "left").where(F.coalesce("n", F.lit(0)) + F.col("weight") >= F.col("least")).select("node")
    edges = near.join(core.toDF("a"), "a", "left_semi").join(core.toDF("b"), "b", "left_semi").select(F.col("a").alias("u"), F.col("b").alias("v"))
    linked = core.join(components(edges).toDF("node", "c"), "node", "left").select("node", F.coalesce("c", "node").alias("c"))
    first = linked.select("c").distinct().withColumn("cell", F.col("c") % cells)
    numbers = first.withColumn("label", F.row_number().over(Window.partitionBy("cell").orderBy("c")) - 1).select("c", "label")
    cores = linked.join(numbers, "c").select("node", "label")
    border = both.join(cores.toDF("b", "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
    return every.join(cores, "node", "left").join(border, "node", "left").select("cell", "point", F.coalesce("label", "near", F.lit(-1)).alias("label"))


def dbscan(distances: DataFrame, points: DataFrame, eps: float, least: int) -> DataFrame:
    """point, label of one density clustering; see ``dbscan_grid``."""
    return dbscan_grid(distances, points, [(eps, least)]).select("point", "label")
