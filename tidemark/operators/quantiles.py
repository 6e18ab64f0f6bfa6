"""Exact quantiles of any number of rows, by a mergeable sketch and refinement.

A round asks the sketch for values around each wanted rank, counts the rows under and at these values in one aggregate,
and keeps for each rank the open interval between two values, or the value itself. A sketch of accuracy A leaves some 4 / A
of an interval's rows. When few rows are left they are grouped by value and read off. Every aggregate combines in its tasks;
what meets in one place are sketches, counts, and ``LEFT`` values at most for each rank.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Relative accuracy of the sketch is 1 / ACCURACY.
ACCURACY = 2000
#: Rows of an interval that are read off by value.
LEFT = 4096


@dataclass
class _Wanted:
    """The row of 0-based ``rank`` has a value over ``low`` and under ``high``; ``under`` rows are at or under ``low``."""

    rank: int
    under: int
    rows: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def inside(self, x):
        out = F.lit(True)
        if self.low is not None:
            out = out & (x > F.lit(self.low))
        if self.high is not None:
            out = out & (x < F.lit(self.high))
        return out


def at_ranks(df: DataFrame, value: str, ranks: list[int], count: int) -> dict[int, float]:
    """The values at 0-based ranks of the ascending order of a double column's ``count`` rows, none of them null; NaN is
    greater than any."""
    wanted = {r: _Wanted(r, 0, count) for r in ranks}
    x = F.col("x")
    rows = df.select(F.col(value).cast("double").alias("x")).where(x.isNotNull())
    while open_ := [w for w in wanted.values() if w.value is None]:
        few = [w for w in open_ if w.rows <= LEFT]
        if few:
            apart = {(w.low, w.high): w for w in few}  # ranks of one interval read it once
            part = F.array_compact(F.array(*[F.when(w.inside(x), F.lit(i)) for i, w in enumerate(apart.values())]))
            counts = rows.where(F.size(part) > 0).select(F.explode(part).alias("part"), "x").groupBy("part", "x").agg(F.count("*").alias("n"))
            held = {k: sorted(((r["x"], r["n"]) for r in got), key=lambda v: (math.isnan(v[0]), v[0])) for k, got in _by_part(counts.collect())}
            place = {k: i for i, k in enumerate(apart)}
            for w in few:
                at = w.under
                for v, n in held[place[w.low, w.high]]:
                    at += n
                    if w.rank < at:
                        w.value = v
                        break
            continue
        asked = []
        for w in open_:
            share = (w.rank - w.under + 0.5) / w.rows
            at = [min(1.0, max(0.0, share + d)) for d in (-2 / ACCURACY, 0, 2 / ACCURACY)]
            asked.append(F.percentile_approx(F.when(w.inside(x), x), F.array(*map(F.lit, at)), F.lit(ACCURACY)))
        found = rows.agg(*[a.alias(f"p{i}") for i, a in enumerate(asked)]).first()
        pivots = [sorted(set(found[f"p{i}"]), key=lambda v: (math.isnan(v), v)) for i in range(len(open_))]
        sums = [f(p).alias(f"{name}{i}_{j}") for i, ps in enumerate(pivots) for j, p in enumerate(ps) for name, f in (("lt", lambda p: F.count_if(x < F.lit(p))), ("eq", lambda p: F.count_if(x == F.lit(p))))]
        seen = rows.agg(*sums).first()
        for i, (w, ps) in enumerate(zip(open_, pivots, strict=True)):
            for j, p in enumerate(ps):
                lt, eq = seen[f"lt{i}_{j}"], seen[f"eq{i}_{j}"]
                if w.rank < lt:
                    w.high, w.rows = p, lt - w.under
                    break
                if w.rank < lt + eq:
                    w.value = p
                    break
                w.low, w.rows, w.under = p, w.rows - (lt + eq - w.under), lt + eq
    return {r: w.value for r, w in wanted.items()}


def _by_part(rows: list) -> list[tuple[int, list]]:
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r["part"], []).append(r)
    return list(out.items())


def quantiles(df: DataFrame, value: str, shares: list[float]) -> list[float | None]:
    """Exact quantiles, interpolated between the two rows around a share's place, as ``percentile`` gives them.

    Null values don't count; NaN is greater than any number. Without any value each is null. Ties and hot values end early.
    """
    count = df.agg(F.count(F.col(value).cast("double")).alias("n")).first()["n"]
    if not count:
        return [None] * len(shares)
    places = [s * (count - 1) for s in shares]
    found = at_ranks(df, value, sorted({f(p) for p in places for f in (math.floor, math.ceil)}), count)
    out = []
    for p in places:
        lo, hi = found[math.floor(p)], found[math.ceil(p)]
        out.append(lo if lo == hi or p == math.floor(p) else (math.ceil(p) - p) * lo + (p - math.floor(p)) * hi)
    return out
