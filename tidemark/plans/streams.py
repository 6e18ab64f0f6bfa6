"""Queries over event time."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import q6
from tidemark.operators import dynamics
from tidemark.plans import views
from tidemark.plans.views import table
from tidemark.scratch import scratch_path
from tidemark.streaming import buckets, feeds
from tidemark.streaming import windows as w

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return keep


def events(spark, d):
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def ntz(df, *cols):
    return df.select(*(F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c) for c in df.columns))


@query(f"select date_trunc('hour', ts) as window_start, event_type, count(*) as n, {views.q6('sum(value)')} as total from events group by 1, 2")
def event_tumbling(spark, d):
    return ntz(w.tumbling(events(spark, d)), "window_start").withColumn("total", q6(F.col("total")))


@query(f"""select window_start, count(*) as n, {views.q6('sum(value)')} as total from (select value,
 unnest([time_bucket(interval 6 hours, ts), time_bucket(interval 6 hours, ts) - interval 6 hours]) as window_start from events) group by 1""")
def event_sliding(spark, d):
    return ntz(w.sliding(events(spark, d), "12 hours", "6 hours"), "window_start").withColumn("total", q6(F.col("total")))


@query("""with x as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 6 hours then 0 else 1 end as new from events),
 y as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as s from x)
 select user_id, min(ts) as session_start, max(ts) + interval 6 hours as session_end, count(*) as n from y group by user_id, s""")
def event_sessions(spark, d):
    return ntz(w.sessions(events(spark, d), "6 hours"), "session_start", "session_end")


WINDOWS = dynamics.windows("2024-01-01", "2024-01-31", 10, 5)


@query("with w as (select * from (values " + ", ".join(f"({i}, timestamp '{a}', timestamp '{z}')" for i, a, z in WINDOWS) + """) t(w, a, z))
 select cast(w as int) as window_id, count(*) as n, count(distinct user_id) as users from w join events on ts >= a and ts < z group by 1""")
def sliding_windows(spark, d):
    bounds = F.array(*(F.struct(F.lit(i).alias("window_id"), F.lit(a).cast("timestamp_ntz").alias("a"), F.lit(z).cast("timestamp_ntz").alias("z")) for i, a, z in WINDOWS))
    x = table(spark, d, "events").select("ts", "user_id", F.inline(bounds)).where("ts >= a and ts < z")
    return x.groupBy("window_id").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("""with l as (select user_id, max(ts) - interval 5 days as last from events group by 1) select event_id, case when ts >= last then 'insert'
 when ts >= last - interval 3 days then 'update' else 'drop' end as action from events join l using (user_id)""")
def late_data_class(spark, d):
    e = table(spark, d, "events")
    last = e.groupBy("user_id").agg(F.expr("max(ts) - interval 5 days").alias("last"))
    return e.join(last, "user_id").select("event_id", w.late_class(F.col("ts"), F.col("last")).alias("action"))


@query(f"""with p as (select event_id % 12 as depth, (event_id * 7919) % 100 < 60 + (event_id % 12) * 4 as is_old from events),
 g as (select depth, avg(cast(is_old as int)) as o, count(*) as n from p group by 1), f as (select min(depth) as f from g where o > 0.9)
 select depth, {views.q6('o')} as old_share, n, f is null or depth <= f + 1 as visited from g, f""")
def depth_stop(spark, d):
    e = table(spark, d, "events")
    depth = F.col("event_id") % 12
    p = e.select(depth.alias("depth"), ((F.col("event_id") * 7919) % 100 < 60 + depth * 4).alias("is_old"))
    return w.stop_depth(p).withColumn("old_share", q6(F.col("old_share")))


def event_files(spark, d):
    """The events' file or folder as a stream."""
    return feeds.read_files(spark, f"{d}/events.parquet*", table(spark, d, "events").schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))


STICKY = """with m as (select event_id, event_type || user_id % 10 as feed, (event_id * 7919) % 1000003 as place, ts from events),
 l as (select feed, max(ts) - interval 26 days as last from m where feed not like '%7' group by 1),
 x as (select event_id, feed, bool_or(coalesce(ts < last, false)) over f as old, bool_or(coalesce(ts < last - interval 3 days, false)) over f as stop
 from m left join l using (feed) window f as (partition by feed order by place))
 select event_id, feed, case when stop then 'drop' when old then 'update' else 'insert' end as action from x"""


def messages(events):
    """Events as messages of feeds, in an order that is not that of their times."""
    feed = F.concat("event_type", (F.col("user_id") % 10).cast("string"))
    return events.select("event_id", feed.alias("feed"), ((F.col("event_id") * 7919) % 1000003).alias("place"), "ts")


def last_seen(spark, d):
    m = messages(table(spark, d, "events"))
    return m.where("feed not like '%7'").groupBy("feed").agg(F.expr("max(ts) - interval 26 days").alias("last"))


@query(STICKY)
def sticky_feed(spark, d):
    out, _ = w.sticky(messages(table(spark, d, "events")), last_seen(spark, d), "feed", "place", "ts")
    return out.select("event_id", "feed", "action")


@query(STICKY)
def sticky_feed_stream(spark, d):
    """The same by a stream with its state in a bucketed table."""
    path = scratch_path(spark, "feeds")
    sink = lambda out, number: out.select("event_id", "feed", "action").write.mode("overwrite").parquet(f"{path}/out/batch={number}")
    each = feeds.sticky_feeds(f"{path}/state", last_seen(spark, d), "feed", "place", "ts", sink, n=8)
    feeds.run_once(messages(event_files(spark, d)), each, f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").select("event_id", "feed", "action")


@query("""with c as (select user_id as doc_id, ts, event_id as num_views, case when event_id % 3 > 0 then event_id % 50 end as num_comments from events where event_type <> 'view'),
 t as (select o_orderkey as document_id, (array_agg(num_views order by ts desc, num_views desc) filter (num_views is not null))[1] as v,
 (array_agg(num_comments order by ts desc, num_comments desc) filter (num_comments is not null))[1] as n from c join orders on o_custkey = doc_id group by 1)
 select distinct l_orderkey as document_id, l_partkey % 20 as topic, v as num_views, n as num_comments from lineitem left join t on document_id = l_orderkey""")
def activity_stream(spark, d):
    """Counters of events passed on to the topic rows of linked documents, by a stream into a bucketed table."""
    path = scratch_path(spark, "activity")
    schema = "document_id long, topic long, num_views long, num_comments long"
    none = F.lit(None).cast("long")
    topic = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("document_id"), (F.col("l_partkey") % 20).alias("topic")).distinct()
    buckets.write(topic.withColumns({"num_views": none, "num_comments": none}), -1, f"{path}/theta", schema, ["document_id"], lambda old, new: new, 16)
    links = table(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("document_id"))
    counters = event_files(spark, d).where("event_type <> 'view'").select(
        F.col("user_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("parsed"), F.col("event_id").alias("num_views"),
        F.when(F.col("event_id") % 3 > 0, F.col("event_id") % 50).alias("num_comments"),
    )
    feeds.run_once(counters, feeds.activity(path, links, schema, ["num_views", "num_comments"], n=16), f"{path}/checkpoint")
    return buckets.read(spark, f"{path}/theta", schema)
