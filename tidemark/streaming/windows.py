"""Event-time windows, late data, frontier stop; the same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tumbling(events: DataFrame, width: str = "1 hour", ts: str = "ts", late: str | None = None) -> DataFrame:
    """window_start, event_type, n, total; ``late`` sets a watermark on a stream."""
    e = events.withWatermark(ts, late) if late else events
    out = e.groupBy(F.window(ts, width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str, step: str, ts: str = "ts", late: str | None = None) -> DataFrame:
    e = events.withWatermark(ts, late) if late else events
    out = e.groupBy(F.window(ts, width, step).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), "n", "total")


def sessions(events: DataFrame, gap: str, key: str = "user_id", ts: str = "ts", late: str | None = None) -> DataFrame:
    """key, session_start, session_end, n: runs of events less than ``gap`` apart."""
    e = events.withWatermark(ts, late) if late else events
    out = e.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


#: How far behind its last document a feed is read.
HORIZON = "INTERVAL 3 DAYS"


def late_class(ts: Column, last: Column, horizon: str = HORIZON) -> Column:
    """Newer than what is known: insert; not over the horizon older: update; else drop."""
    return F.when(ts >= last, "insert").when(ts >= last - F.expr(horizon), "update").otherwise("drop")


def sticky(
    messages: DataFrame, last: DataFrame, feed: str, at: str, ts: str, horizon: str = HORIZON, state: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(messages with ``action``, places): feeds read in the order ``at``, whatever the order of their times.

    From the first message older than the feed's ``last`` (feed, last) on all are updates; from the first that is older by
    more than the horizon on all are dropped, that one included; those before are inserts. So a feed's two first places
    (feed, old_at, stop_at; null: none yet) decide, found by a grouped minimum that is combined before the shuffle: no
    feed is sorted. ``state``: places that earlier batches found. A feed without ``last`` (or with a null one) takes
    everything in; a message with a null time is never old; null feeds are one feed; messages at equal places are older or
    dropped together. ``last`` and ``state`` have a row at most for each feed.
    """
    known = messages.join(last.select(F.col(feed).alias("__feed"), F.col("last").alias("__last")), F.col(feed).eqNullSafe(F.col("__feed")), "left").drop("__feed")
    old, stop = F.col(ts) < F.col("__last"), F.col(ts) < F.col("__last") - F.expr(horizon)
    places = known.groupBy(feed).agg(F.min(F.when(old, F.col(at))).cast("long").alias("old_at"), F.min(F.when(stop, F.col(at))).cast("long").alias("stop_at"))
    if state is not None:
        places = places.unionByName(state.select(feed, "old_at", "stop_at")).groupBy(feed).agg(F.min("old_at").alias("old_at"), F.min("stop_at").alias("stop_at"))
    named = places.select(F.col(feed).alias("__feed"), F.col("old_at").alias("__old"), F.col("stop_at").alias("__stop"))
    action = F.when(F.col(at) >= F.col("__stop"), "drop").when(F.col(at) >= F.col("__old"), "update").otherwise("insert")
    out = messages.join(named, F.col(feed).eqNullSafe(F.col("__feed")), "left").withColumn("action", action)
    return out.select(*messages.columns, "action"), places


def stop_depth(pages: DataFrame, depth: str = "depth", old: str = "is_old", share: float = 0.9) -> DataFrame:
    """depth, old_share, visited: a crawl goes one level past the first where more than ``share`` of pages are old."""
    per = pages.groupBy(depth).agg(F.avg(F.col(old).cast("int")).alias("old_share"), F.count("*").alias("n"))
    full = F.when(F.col("old_share") > share, F.col(depth))
    first = F.min(full).over(Window.partitionBy())
    return per.withColumn("visited", first.isNull() | (F.col(depth) <= first + 1))


def dedup(events: DataFrame, keys: list[str], ts: str = "ts", late: str = "3 days") -> DataFrame:
    """One event for each key within the horizon, on a stream."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
