"""Density clustering of vectors by cosine distance without a table of the pairs.

Points are cut into blocks of near ones. Blocks whose balls are within reach of each other meet in matrix products, in memory of
two blocks, and a task tells only counts of points that are not yet core, a spanning forest of the blocks' own components
and the least cluster of each border point. So the work may grow with the pairs of blocks, but disk grows with the points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.clusters import MOST_FOREST, _forest
from tidemark.operators.graph import components
from tidemark.scratch import stored

#: Points of a block at most, components of its vectors at most, and points of a block that meet another's at a time.
BLOCK, BLOCK_CELLS, AT_ONCE = 1024, 1 << 20, 128
#: Points that the cuts into blocks are fitted on (any cuts give the same clusters), and rows that a task holds.
SAMPLE, MOST_HELD = 20_000, 1_000_000

_ROW = "block long, center array<double>, radius double, ids binary, mat binary, norm binary, more binary"


def dbscan(points: DataFrame, eps: float, least: int) -> DataFrame:
    """point, label: label -1 is noise; clusters count from 0 by their least core point; a border point joins the lowest.

    ``points``: point (a long), vec (an array of doubles, all of one length), own (a sum of squares that only the point's own norm
    has), weight (how many points at one place it stands for). Two are neighbours if their cosine distance, to nine decimals, is at
    most ``eps``. Vectors of zeros are near nothing but themselves.
    """
    spark = points.sparkSession
    points = stored(points.select("point", "vec", F.col("own").cast("double").alias("own"), F.col("weight").cast("long").alias("weight")), "vectors")
    n, width = points.agg(F.count("*"), F.max(F.size("vec"))).first()
    width, size = width or 0, max(1, min(BLOCK, BLOCK_CELLS // max(1, width or 1)))
    unit = F.sqrt(F.aggregate("vec", F.col("own"), lambda a, x: a + x * x))
    known = points.orderBy(F.xxhash64("point")).select(F.transform("vec", lambda x: F.coalesce(F.try_divide(x, unit), F.lit(0.0))).alias("u")).limit(max(64, min(SAMPLE, (1 << 24) // max(1, width))))
    known = [r["u"] for r in known.toLocalIterator()]
    tree = _tree(np.array(known).reshape(len(known), width), -(-n // size))
    leaves = points.mapInArrow(_dealer(tree, width), "leaf int, point long, vec array<double>, own double, weight long")
    spread = lambda x: x.repartition(4 * spark.sparkContext.defaultParallelism, "block")
    blocks = stored(spread(leaves.groupBy("leaf").applyInArrow(_cut(size, width, eps), _ROW)), "blocks", **{"parquet.page.size.row.check.min": 16, "parquet.block.size": 16 << 20})

    # which points are core
    open_ = stored(spread(blocks.mapInArrow(_only(width, lambda more: more < least), _ROW)), "open")
    met = _near(open_, blocks, eps, width).where("block <> other").mapInArrow(_counts(width, eps), "block long, point long, n long")
    own = open_.mapInArrow(_listed, "block long, point long, n long")
    late = own.unionByName(met).groupBy("block", "point").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    late = late.groupBy("block").agg(F.collect_list("point").alias("late"))
    split = stored(spread(blocks.join(late, "block", "left").mapInArrow(_components(width, eps, least), _ROW + ", core boolean")), "split")
    cores, others = split.where("core").drop("core"), split.where("not core").drop("core")

    # which of the blocks' components are one
    edges = stored(_near(cores, cores, eps, width).where("block < other").mapInArrow(_links(width, eps), "u long, v long"), "links")
    own = cores.mapInArrow(_listed, "block long, point long, n long")
    parts = own.select("block", F.col("n").alias("part")).distinct()
    if edges.count() <= MOST_FOREST:
        roots = edges.groupBy(F.lit(0).alias("k")).applyInArrow(_roots, "node long, component long")
    else:
        roots = components(edges)
    named = parts.join(roots.toDF("part", "c"), "part", "left").select("block", "part", F.coalesce("c", "part").alias("c"))
    named = stored(named, "parts")
    label = stored(named.select("c").distinct().select("c", (F.row_number().over(Window.orderBy("c")) - 1).cast("long").alias("label")), "labels")

    # which cluster the others join
    told = named.groupBy("block").agg(F.collect_list(F.struct("part", "c")).alias("parts"))
    labelled = spread(cores.join(told, "block").mapInArrow(_renamed, _ROW))
    border = _near(others, labelled, eps, width).mapInArrow(_borders(width, eps), "point long, c long").groupBy("point").agg(F.min("c").alias("c"))
    inside = own.select("block", "point", F.col("n").alias("part")).join(named, ["block", "part"]).select("point", "c")
    found = inside.unionByName(border).join(label, "c").select("point", "label")
    return points.select("point").join(found, "point", "left").select("point", F.coalesce("label", F.lit(-1)).alias("label"))


def _near(a: DataFrame, b: DataFrame, eps: float, width: int) -> DataFrame:
    """Pairs of blocks whose balls are within reach. Unit vectors at cosine distance d lie sqrt(2 d) apart."""
    b = b.toDF("other", "other_center", "other_radius", "other_ids", "other_mat", "other_norm", "other_more")
    apart = F.sqrt(F.aggregate(F.zip_with("center", "other_center", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    return a.crossJoin(b).where(apart <= F.col("radius") + F.col("other_radius") + F.lit(float(np.sqrt(2 * (eps + 1e-8)) + 1e-9)))


def _tree(x: np.ndarray, leaves: int) -> list:
    """Cuts at the middle of the widest column: (column, value, below, above) or a leaf's number."""
    numbers = iter(range(1 << 31))

    def cut(x: np.ndarray, leaves: int):
        if leaves > 1 and len(x) > 16 and x.shape[1]:
            c = int(np.argmax(np.ptp(x, axis=0)))
            v = float(np.median(x[:, c]))
            up = x[:, c] > v
            if up.any():
                return (c, v, cut(x[~up], leaves // 2), cut(x[up], leaves - leaves // 2))
        return next(numbers)

    return cut(x, leaves)


def _units(mat: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return np.divide(mat, norm[:, None], out=np.zeros_like(mat), where=norm[:, None] > 0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _norms(mat: np.ndarray, own: np.ndarray) -> np.ndarray:
    return np.sqrt((mat * mat).sum(axis=1) + own)


def _dealer(tree, width: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mat = _matrix(b.column("vec"), width)
            unit, leaf = _units(mat, _norms(mat, b.column("own").to_numpy())), np.zeros(len(mat), np.int32)
            todo = [(tree, np.arange(len(mat)))]
            while todo:
                t, at = todo.pop()
                if not isinstance(t, tuple):
                    leaf[at] = t
                    continue
                up = unit[at, t[0]] > t[1]
                todo += [(t[2], at[~up]), (t[3], at[up])]
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *b.columns], ["leaf", *b.schema.names])

    return deal


def _close(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, eps: float) -> np.ndarray:
    """Whether rows of a and b are neighbours. The distance is rounded as SQL's floor(d * 1e9 + 0.5) / 1e9."""
    most = int(eps * 1e9) + 2
    while most / 1e9 > eps:
        most -= 1
    with np.errstate(all="ignore"):
        d = a @ b.T
        d /= na[:, None] * nb[None]
        np.subtract(1.0, d, out=d)
        d *= 1e9
        d += 0.5
        return d < most + 1  # NaN is not


def _packed(block: int, unit: np.ndarray, ids: np.ndarray, mat: np.ndarray, norm: np.ndarray, more: np.ndarray) -> tuple:
    center = (unit.min(axis=0) + unit.max(axis=0)) / 2 if len(unit) else np.zeros(mat.shape[1])
    radius = float(np.sqrt(((unit - center) ** 2).sum(axis=1).max(initial=0.0)))
    return (block, center.tolist(), radius, *(np.ascontiguousarray(x).tobytes() for x in (ids, mat, norm, more)))


_SCHEMA = pa.schema(
    [("block", pa.int64()), ("center", pa.list_(pa.float64())), ("radius", pa.float64()), *((c, pa.binary()) for c in ("ids", "mat", "norm", "more"))]
)


def _batch(rows: list[tuple], core: list[bool] | None = None) -> pa.RecordBatch:
    cols = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_SCHEMA)]
    return pa.RecordBatch.from_arrays(cols + ([] if core is None else [pa.array(core)]), _SCHEMA.names + ([] if core is None else ["core"]))


def _side(b: pa.RecordBatch, i: int, width: int, before: str = "") -> tuple[np.ndarray, ...]:
    """ids, mat, norm, more of a block."""
    ids, mat, norm, more = (np.frombuffer(b.column(before + c)[i].as_buffer(), t) for c, t in (("ids", np.int64), ("mat", np.float64), ("norm", np.float64), ("more", np.int64)))
    return ids, mat.reshape(len(ids), width), norm, more


def _cut(size: int, width: int, eps: float):
    """A leaf's blocks; ``more``: the weight of each point's neighbours in its block, with itself, as is."""

    def cut(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        ids, own, weight = (t[c].to_numpy() for c in ("point", "own", "weight"))
        mat = _matrix(pa.concat_arrays(t["vec"].chunks), width)
        norm = _norms(mat, own)
        unit, rows = _units(mat, norm), []
        todo, leaf = [np.arange(len(ids))], t["leaf"][0].as_py()
        while todo:
            at = todo.pop()
            if len(at) > size:
                c = int(np.argmax(np.ptp(unit[at], axis=0))) if width else 0
                at = at[np.argsort(unit[at, c], kind="stable")] if width else at
                todo += [at[: len(at) // 2], at[len(at) // 2 :]]
                continue
            near = _close(mat[at], norm[at], mat[at], norm[at], eps)
            np.fill_diagonal(near, True)
            rows.append(_packed((leaf << 32) + len(rows), unit[at], ids[at], mat[at], norm[at], near @ weight[at]) + (weight[at],))
        # the weights stand behind the numbers of neighbours
        return pa.Table.from_batches([_batch([(*r[:6], r[6] + np.ascontiguousarray(r[7]).tobytes()) for r in rows])])

    return cut


def _weighed(more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return more[: len(more) // 2], more[len(more) // 2 :]


def _only(width: int, wanted):
    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, mat, norm, more = _side(b, i, width)
                n, _ = _weighed(more)
                at = np.flatnonzero(wanted(n))
                if len(at):
                    yield _batch([_packed(b.column("block")[i].as_py(), _units(mat[at], norm[at]), ids[at], mat[at], norm[at], n[at])])

    return only


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            ids, more = (np.frombuffer(b.column(c)[i].as_buffer(), np.int64) for c in ("ids", "more"))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), b.column("block")[i].as_py())), pa.array(ids), pa.array(more)], ["block", "point", "n"])


def _counts(width: int, eps: float):
    """Weights of the neighbours in other blocks, added up over the blocks that a task meets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for block, (ids, n) in held.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), block)), pa.array(ids[at]), pa.array(n[at])], ["block", "point", "n"])
            held.clear()

        size = 0
        for b in batches:
            for i in range(b.num_rows):
                ids, mat, norm, _ = _side(b, i, width)
                _, mat2, norm2, more2 = _side(b, i, width, "other_")
                n = _close(mat, norm, mat2, norm2, eps) @ _weighed(more2)[1]
                block = b.column("block")[i].as_py()
                if block in held:
                    held[block][1] += n
                else:
                    held[block] = [ids.copy(), n]
                    size += len(ids)
                if size > MOST_HELD:
                    yield from told()
                    size = 0
        yield from told()

    return count


def _grown(near: np.ndarray) -> np.ndarray:
    """Numbers of the components of a symmetric matrix."""
    of, c = np.full(len(near), -1), 0
    for i in range(len(near)):
        if of[i] < 0:
            of[i], front = c, np.array([i])
            while len(front):
                front = np.flatnonzero(near[front].any(axis=0) & (of < 0))
                of[front] = c
            c += 1
    return of


def _components(width: int, eps: float, least: int):
    """A block's core points, ``more`` being the least core point of their component inside the block; and its others."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, mat, norm, more = _side(b, i, width)
                core = (_weighed(more)[0] >= least) | np.isin(ids, np.array(b.column("late")[i].as_py() or [], np.int64))
                block, at, rest = b.column("block")[i].as_py(), np.flatnonzero(core), np.flatnonzero(~core)
                if len(at):
                    of = _grown(_close(mat[at], norm[at], mat[at], norm[at], eps))
                    first = np.full(of.max() + 1, np.iinfo(np.int64).max)
                    np.minimum.at(first, of, ids[at])
                    order = np.argsort(of, kind="stable")
                    at, of = at[order], of[order]
                    yield _batch([_packed(block, _units(mat[at], norm[at]), ids[at], mat[at], norm[at], first[of])], [True])
                if len(rest):
                    yield _batch([_packed(block, _units(mat[rest], norm[rest]), ids[rest], mat[rest], norm[rest], np.zeros(len(rest), np.int64))], [False])

    return split


def _links(width: int, eps: float):
    """A spanning forest of the components that the pairs of blocks of a task link. A block's points stand by component."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 2
        top = MOST_HELD

        def thin() -> None:
            keep = _forest(np.zeros(len(held[0]), np.int32), *held)[0]
            held[:] = [x[keep] for x in held]

        for b in batches:
            for i in range(b.num_rows):
                _, mat, norm, part = _side(b, i, width)
                _, mat2, norm2, part2 = _side(b, i, width, "other_")
                begins2 = np.flatnonzero(np.append(True, part2[1:] != part2[:-1]))
                names, names2 = part[np.flatnonzero(np.append(True, part[1:] != part[:-1]))], part2[begins2]
                number = np.cumsum(np.append(False, part[1:] != part[:-1]))
                linked = np.zeros((len(names), len(names2)), bool)
                for lo in range(0, len(mat), AT_ONCE):
                    at = np.arange(lo, min(lo + AT_ONCE, len(mat)))
                    at = at[~linked[number[at]].all(axis=1)]
                    if len(at):
                        np.logical_or.at(linked, number[at], np.logical_or.reduceat(_close(mat[at], norm[at], mat2, norm2, eps), begins2, axis=1))
                u, v = np.nonzero(linked)
                held[:] = [np.append(held[0], names[u]), np.append(held[1], names2[v])]
                if len(held[0]) > top:
                    thin()
                    top = max(MOST_HELD, 2 * len(held[0]))
        thin()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["u", "v"])

    return link


def _roots(t: pa.Table) -> pa.Table:
    """node, component: the least node that each is linked with."""
    a, b = (t[c].to_numpy() for c in ("u", "v"))
    keep, nodes, at = _forest(np.zeros(len(a), np.int32), a, b)
    root = np.arange(len(nodes))
    for x, y in zip(at[: len(a)][keep].tolist(), at[len(a) :][keep].tolist(), strict=True):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        root[max(x, y)] = min(x, y)
    while (root != root[root]).any():
        root = root[root]
    return pa.table({"node": nodes, "component": nodes[root]})


def _renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``more`` as the cluster's least core point instead of the component's."""
    for b in batches:
        for i in range(b.num_rows):
            parts = sorted((p["part"], p["c"]) for p in b.column("parts")[i].as_py())
            part, c = (np.array(x, np.int64) for x in zip(*parts, strict=True))
            more = c[np.searchsorted(part, np.frombuffer(b.column("more")[i].as_buffer(), np.int64))]
            cells = [b.column(f.name).slice(i, 1) for f in list(_SCHEMA)[:-1]]
            yield pa.RecordBatch.from_arrays([*cells, pa.array([more.tobytes()])], _SCHEMA.names)


def _borders(width: int, eps: float):
    """The least cluster near each point that is not core, over the blocks that a task meets."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, held, size = np.iinfo(np.int64).max, {}, 0

        def told() -> Iterator[pa.RecordBatch]:
            for ids, c in held.values():
                at = np.flatnonzero(c < none)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(c[at])], ["point", "c"])
            held.clear()

        for b in batches:
            for i in range(b.num_rows):
                ids, mat, norm, _ = _side(b, i, width)
                _, mat2, norm2, cluster = _side(b, i, width, "other_")
                block = b.column("block")[i].as_py()
                if block not in held:
                    held[block] = [ids.copy(), np.full(len(ids), none)]
                    size += len(ids)
                for lo in range(0, len(ids), AT_ONCE):
                    p = slice(lo, lo + AT_ONCE)
                    near = _close(mat[p], norm[p], mat2, norm2, eps)
                    held[block][1][p] = np.minimum(held[block][1][p], np.where(near, cluster[None], none).min(axis=1))
                if size > MOST_HELD:
                    yield from told()
                    size = 0
        yield from told()

    return find
