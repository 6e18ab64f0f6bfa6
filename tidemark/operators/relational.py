"""Corpus selection and incremental loading: search, slices, filters by membership, upserts, cursors."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_COMPARE = {
    "gte": lambda c, v: c >= v,
    "lte": lambda c, v: c <= v,
    "gt": lambda c, v: c > v,
    "lt": lambda c, v: c < v,
}


def predicate(name: str, value: object) -> Column:
    """``name__gte`` and the like compare, a list means IN, ``name__exists`` tests for null, a scalar is equal."""
    field, _, kind = name.partition("__")
    if kind == "exists":
        return F.col(field).isNotNull() if value else F.col(field).isNull()
    if kind:
        return _COMPARE[kind](F.col(field), value)
    return F.col(field).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(field) == value


def search(
    df: DataFrame, query: Mapping[str, object] | None = None, source: list[str] | None = None, sort: list[str] | None = None, start: int = 0, end: int | None = None
) -> DataFrame:
    """Filters by dictionary, then order, slice [start, end) and projection; ``-name`` sorts down."""
    for k, v in (query or {}).items():
        df = df.where(predicate(k, v))
    if sort:
        df = df.orderBy(*(F.desc(s[1:]) if s.startswith("-") else F.asc(s) for s in sort))
    if start:
        df = df.offset(start)
    if end is not None:
        df = df.limit(end - start)
    return df.select(*source) if source else df


def shard(df: DataFrame, key: str, total: int, number: int | None = None) -> DataFrame:
    """Rows of shard ``number`` of ``total`` (all, with their shard, if None)."""
    df = df.withColumn("shard", F.pmod(F.col(key), F.lit(total)))
    return df if number is None else df.where(F.col("shard") == number)


def numbered(df: DataFrame, key: str, width: int = 65_536, name: str = "row_number") -> DataFrame:
    """1-based place by an integer key. Ranges of keys are counted, so that no task orders more than one range.

    Ties share a range; their order is arbitrary. A range holds ``width`` distinct keys at most. Null keys come first.
    """
    ranged = df.withColumn("__range", F.expr(f"{key} div {width}"))
    counts = ranged.groupBy("__range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("__range", F.coalesce(before, F.lit(0)).alias("__base"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(key))
    placed = ranged.join(bases.withColumnRenamed("__range", "__r"), F.col("__range").eqNullSafe(F.col("__r")))
    return placed.withColumn(name, F.col("__base") + inside).drop("__range", "__r", "__base")


def percent_slice(df: DataFrame, key: str, start: float, end: float) -> DataFrame:
    """Rows int(start% of N) up to int(end% of N), both included: neighbouring slices share one row."""
    n = df.agg(F.count("*").alias("__n"))
    placed = numbered(df, key).crossJoin(F.broadcast(n))
    low, high = (F.floor(F.lit(p / 100) * F.col("__n")) for p in (start, end))
    return placed.where((F.col("row_number") > low) & (F.col("row_number") <= high + 1)).drop("__n")


def within_dates(df: DataFrame, start: datetime | None, end: datetime | None, exempt: Iterable[str] = (), ts: str = "datetime", corpus: str = "corpus") -> DataFrame:
    """Rows dated in [start, end]; undated rows stay only in exempt corpora; without bounds all stay."""
    if start is None and end is None:
        return df
    dated = F.lit(True)
    if start is not None:
        dated = dated & (F.col(ts) >= F.lit(start))
    if end is not None:
        dated = dated & (F.col(ts) <= F.lit(end))
    undated = F.col(ts).isNull() & F.col(corpus).isin(list(exempt)) if list(exempt) else F.lit(False)
    return df.where(dated | undated)


def corpus_counts(df: DataFrame, before: datetime, ts: str = "datetime", corpus: str = "corpus") -> DataFrame:
    """Rows of each corpus, those strictly before a time, and those up to it."""
    return df.groupBy(corpus).agg(
        F.count("*").alias("n_all"), F.count_if(F.col(ts) < F.lit(before)).alias("n_before"), F.count_if(F.col(ts) <= F.lit(before)).alias("n_until")
    )


def admit(
    docs: DataFrame, *, least_length: int = 100, exempt_word: str = "hate", group: DataFrame | None = None, skip: DataFrame | None = None,
    gate: Column | None = None, most: int | None = None, keys: Iterable[str] = ("doc_id",), text: str = "text", corpus: str = "corpus",
) -> DataFrame:
    """Documents for a topic model: long enough (unless the corpus is exempt by name), in the group, not in the skip set,
    through the language gate; of those that pass, one for each value of each key; ``most`` of them at most. ``group`` and
    ``skip`` name documents by the first key."""
    first, *_ = keys
    out = docs.where((F.length(text) >= least_length) | F.contains(F.lower(F.col(corpus)), F.lit(exempt_word)))
    if gate is not None:
        out = out.where(gate)
    if group is not None:
        out = out.join(group, first, "left_semi")
    if skip is not None:
        out = out.join(skip, first, "left_anti")
    for key in keys:
        out = out.dropDuplicates([key])
    return out.limit(most) if most is not None else out


def members(theta: DataFrame, topics: list[str], least: float) -> DataFrame:
    """Distinct documents with a topic of the group at ``least`` weight."""
    return theta.where(F.col("topic_id").isin(topics) & (F.col("topic_weight") >= least)).select("document_id").distinct()


def insert_absent(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``new`` rows whose key the target lacks, one for each key; append them."""
    return new.dropDuplicates([key]).join(target.select(key), key, "left_anti")


def with_dimension(facts: DataFrame, dimension: DataFrame, natural: str, surrogate: str) -> tuple[DataFrame, DataFrame]:
    """(dimension with the facts' new natural keys, facts with the surrogate key); new keys continue the greatest.

    New keys are numbered within 4096 buckets of their hash, each after those of the buckets before it.
    """
    new = facts.select(natural).where(F.col(natural).isNotNull()).distinct().join(dimension.select(natural), natural, "left_anti")
    new = new.withColumn("__bucket", F.pmod(F.xxhash64(natural), F.lit(4096)))
    counts = new.groupBy("__bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = dimension.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("__top"))
    bases = counts.select("__bucket", before.alias("__base")).crossJoin(F.broadcast(top))
    inside = F.row_number().over(Window.partitionBy("__bucket").orderBy(natural))
    keyed = new.withColumn("__n", inside).join(bases, "__bucket")
    whole = dimension.unionByName(keyed.select(natural, (F.col("__top") + F.col("__base") + F.col("__n")).alias(surrogate)))
    return whole, facts.join(whole, natural, "left")


def merge_update(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Partial update: a change's non-null columns replace the target's."""
    cols = [c for c in changes.columns if c != key]
    c = changes.select(key, *(F.col(x).alias(f"__{x}") for x in cols))
    out = target.join(c, key, "left")
    return out.select(*(F.coalesce(f"__{x}", x).alias(x) if x in cols else F.col(x) for x in target.columns))


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], modified: Column | None = None) -> DataFrame:
    """``target`` with rows of ``changes`` in place of those with equal keys (null equals null), and added where there are
    none; ``modified`` stamps the changed rows. Of changes with equal keys one is taken."""
    new = changes.dropDuplicates(keys)
    if modified is not None:
        new = new.withColumn("modified", modified)
    on = None
    for k in keys:
        same = target[k].eqNullSafe(new[k])
        on = same if on is None else on & same
    return target.join(new, on, "left_anti").unionByName(new, allowMissingColumns=True)


def increased_only(target: DataFrame, changes: DataFrame, key: str, counter: str) -> DataFrame:
    """Update a counter only where it grew."""
    out = target.join(changes.select(key, F.col(counter).alias("__new")), key, "left")
    return out.withColumn(counter, F.greatest(counter, "__new")).drop("__new")


def latest(df: DataFrame, group: str, ts: str, tie: str) -> DataFrame:
    """The latest row of each group as columns, ties by the greatest ``tie``."""
    return df.groupBy(group).agg(F.max_by(F.struct(*df.columns), F.struct(ts, tie)).alias("r")).select("r.*")


def first_rows(df: DataFrame, group: str, *order: str) -> DataFrame:
    """The first row of each group by ``order``, as columns."""
    return df.groupBy(group).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")


def fetch_since(sources: DataFrame, docs: DataFrame, source: str, ts: str, now: datetime) -> DataFrame:
    """source, since: a week before the source's latest document, or a year before ``now`` where it has none."""
    last = docs.groupBy(source).agg(F.max(ts).alias("__last"))
    since = F.coalesce(F.col("__last") - F.expr("INTERVAL 7 DAYS"), F.lit(now).cast("timestamp_ntz") - F.expr("INTERVAL 365 DAYS"))
    return sources.select(source).distinct().join(last, source, "left").select(source, since.alias("since"))


def cursor_batch(df: DataFrame, key: str, since: int, most: int) -> DataFrame:
    """Rows with since < key <= min(greatest key, since + most)."""
    return df.where((F.col(key) > since) & (F.col(key) <= since + most))


def shards_for_rows(n: Column) -> Column:
    """Storage shards by row count."""
    return F.when(n > 10_000_000, 5).when(n > 1_000_000, 3).when(n > 100_000, 2).otherwise(1)


def priority_band(x: Column) -> Column:
    return F.when(x >= 75, "high").when(x > 25, "medium").otherwise("low")


def needs_refresh(published: Column, last: Column, now: Column) -> Column:
    """A week old and not parsed since a week after publication, or a month likewise."""
    stale = lambda days: (F.datediff(now, published) >= days) & (last.isNull() | (F.datediff(last, published) <= days))
    return stale(7) | stale(30)


def is_dirty(parsed: Column, updated: Column, *counters: Column) -> Column:
    """Parsed a minute or more after the last update (or never updated), with some counter known."""
    known = F.lit(False)
    for c in counters:
        known = known | c.isNotNull()
    return (updated.isNull() | (parsed >= updated + F.expr("INTERVAL 1 MINUTE"))) & known
