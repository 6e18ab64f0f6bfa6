"""Queries of corpus selection and incremental loading."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.columns import is_latin
from tidemark.operators import posts
from tidemark.operators import relational as r
from tidemark.plans import views
from tidemark.plans.views import THETA_DT_SQL, THETA_SQL, q6, table

QUERIES, ORACLES = {}, {}


def query(sql: str):
    """Register a query under its function's name, with its SQL."""

    def keep(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return keep


@query("""select event_id, user_id, event_type, value from events where event_type in ('click', 'view', 'purchase') and value >= 10 and user_id < 100
 order by event_id limit 450 offset 50""")
def generic_search(spark, d):
    return r.search(
        table(spark, d, "events"), {"event_type": ["click", "view", "purchase"], "value__gte": 10, "user_id__lt": 100},
        source=["event_id", "user_id", "event_type", "value"], sort=["event_id"], start=50, end=500,
    )


@query("""select o_orderstatus as corpus, count(*) as n_all, count(*) filter (o_orderdate < timestamp '1997-01-01') as n_before,
 count(*) filter (o_orderdate <= timestamp '1997-01-01') as n_until from orders group by 1""")
def corpus_count(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderstatus").alias("corpus"), F.col("o_orderdate").alias("datetime"))
    return r.corpus_counts(o, datetime(1997, 1, 1))


@query("select doc_id, n_chars, doc_id % 4 as shard from documents where doc_id % 4 = 1")
def shard_scan(spark, d):
    return r.shard(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id", 4, 1)


@query("""with n as (select count(*) as n from documents), p as (select doc_id, row_number() over (order by doc_id) as row_number from documents)
 select doc_id, row_number from p, n where row_number > floor(0.25 * n) and row_number <= floor(0.5 * n) + 1""")
def percent_slice(spark, d):
    return r.percent_slice(table(spark, d, "documents").select("doc_id"), "doc_id", 25, 50)


@query("""select o_orderkey, c_name, n_name from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
 join region on r_regionkey = n_regionkey where r_name = 'ASIA' and o_totalprice > 1000""")
def fk_lookup_filter(spark, d):
    o, c, n, g = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    return (
        o.where("o_totalprice > 1000").join(c, F.col("c_custkey") == F.col("o_custkey")).join(n, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(g.where("r_name = 'ASIA'"), F.col("r_regionkey") == F.col("n_regionkey")).select("o_orderkey", "c_name", "n_name")
    )


@query("""select doc_id, quality is not null as labelled, quality from documents left join labels using (doc_id)
 where quality is null or toxic = 1""")
def null_filters(spark, d):
    x = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return x.where(r.predicate("quality__exists", False) | r.predicate("toxic", 1)).select("doc_id", F.col("quality").isNotNull().alias("labelled"), "quality")


DATED = """dated as (select o_orderkey as doc_id, o_orderstatus as corpus, case when o_orderkey % 3 = 0 then null else o_orderdate end as datetime from orders)"""


@query(f"""with {DATED} select doc_id, corpus from dated where (datetime >= timestamp '1995-01-01' and datetime <= timestamp '1996-06-30')
 or (datetime is null and corpus in ('P'))""")
def corpus_date_filter(spark, d):
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("doc_id"), F.col("o_orderstatus").alias("corpus"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")).alias("datetime")
    )
    return r.within_dates(o, datetime(1995, 1, 1), datetime(1996, 6, 30), ["P"]).select("doc_id", "corpus")


@query("""select doc_id, lang as corpus from documents where (length(text) >= 100 or lang = 'es') and doc_id in (select doc_id from labels where quality = 1)
 and doc_id not in (select doc_id from labels where toxic = 1) and length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) / length(text) > 0.51""")
def document_admission(spark, d):
    docs, labels = views.docs(spark, d).select("doc_id", "text", "corpus"), table(spark, d, "labels")
    return r.admit(
        docs, exempt_word="es", group=labels.where("quality = 1").select("doc_id"), skip=labels.where("toxic = 1").select("doc_id"), gate=is_latin(F.col("text"))
    ).select("doc_id", "corpus")


@query(f"""with {THETA_SQL} select o_orderkey as document_id, o_orderstatus as corpus from orders where o_orderkey in
 (select document_id from theta where topic_id in ('topic_1', 'topic_2', 'topic_3') and topic_weight >= 0.1)""")
def group_filter(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("document_id"), F.col("o_orderstatus").alias("corpus"))
    return o.join(r.members(views.theta(spark, d), ["topic_1", "topic_2", "topic_3"], 0.1), "document_id", "left_semi")


@query(f"with {THETA_SQL} select document_id, topic_id, {q6('topic_weight')} as topic_weight from theta where topic_weight >= 0.1")
def theta_threshold(spark, d):
    from tidemark.functions.columns import q6

    return views.theta(spark, d).where("topic_weight >= 0.1").select("document_id", "topic_id", q6(F.col("topic_weight")).alias("topic_weight"))


@query("""select o_orderkey as document_id from orders where o_orderkey not in (select l_orderkey from lineitem where l_shipdate < timestamp '1995-06-01')""")
def actualize_anti(spark, d):
    done = table(spark, d, "lineitem").where("l_shipdate < timestamp'1995-06-01'").select(F.col("l_orderkey").alias("document_id"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("document_id")).join(done, "document_id", "left_anti")


@query(f"""with {THETA_SQL} select distinct document_id from theta where topic_weight >= 0.05 and document_id not in (select o_orderkey from orders where o_orderstatus = 'F')""")
def eval_actualize(spark, d):
    done = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("document_id"))
    return views.theta(spark, d).where("topic_weight >= 0.05").select("document_id").distinct().join(done, "document_id", "left_anti")


def _topic_docs(spark, d, topic):
    return views.theta(spark, d).where((F.col("topic_id") == topic) & (F.col("topic_weight") >= 0.05)).select("document_id")


def _topic_docs_sql(topic: str) -> str:
    return f"(select document_id from theta where topic_id = '{topic}' and topic_weight >= 0.05)"


@query(f"with {THETA_SQL} {_topic_docs_sql('topic_1')} intersect {_topic_docs_sql('topic_2')}")
def docs_intersect(spark, d):
    return _topic_docs(spark, d, "topic_1").intersect(_topic_docs(spark, d, "topic_2"))


@query(f"with {THETA_SQL} {_topic_docs_sql('topic_1')} except {_topic_docs_sql('topic_2')}")
def docs_except(spark, d):
    return _topic_docs(spark, d, "topic_1").subtract(_topic_docs(spark, d, "topic_2"))


@query(f"with {THETA_SQL} {_topic_docs_sql('topic_1')} union {_topic_docs_sql('topic_2')}")
def docs_union(spark, d):
    return _topic_docs(spark, d, "topic_1").union(_topic_docs(spark, d, "topic_2")).distinct()


@query("""select distinct l_suppkey as s_suppkey from lineitem where l_quantity > 40 and l_suppkey not in (select s_suppkey from supplier where s_acctbal > 5000)""")
def insert_if_absent(spark, d):
    target = table(spark, d, "supplier").where("s_acctbal > 5000").select("s_suppkey")
    return r.insert_absent(target, table(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_suppkey").alias("s_suppkey")), "s_suppkey")


@query("""select user_id, event_id, ts, ts - interval 7 days as since from
 (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events) where n = 1""")
def latest_per_source(spark, d):
    last = r.latest(table(spark, d, "events").select("user_id", "event_id", "ts"), "user_id", "ts", "event_id")
    return last.withColumn("since", F.expr("ts - interval 7 days"))


@query("""select c_custkey as o_custkey, coalesce(max(o_orderdate) - interval 7 days, timestamp '1998-08-02' - interval 365 days) as since
 from customer left join orders on o_custkey = c_custkey group by 1""")
def fetch_since(spark, d):
    sources = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return r.fetch_since(sources, table(spark, d, "orders"), "o_custkey", "o_orderdate", datetime(1998, 8, 2))


@query("""select o_custkey, o_orderkey, o_orderdate from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as n from orders) where n = 1""")
def first_per_group(spark, d):
    return r.first_rows(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", "o_orderdate", "o_orderkey")


AGED = "select l_orderkey, l_linenumber, l_shipdate::date as pub, case when l_linenumber % 3 = 0 then null else l_shipdate::date + cast(l_quantity as integer) end as last from lineitem"


@query(f"""with x as ({AGED}), y as (select *, date '1996-01-15' - pub as age from x)
 select l_orderkey, l_linenumber from y where (age >= 7 and (last is null or last - pub <= 7)) or (age >= 30 and (last is null or last - pub <= 30))""")
def refresh_policy(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("pub"), "l_quantity")
    x = x.withColumn("last", F.when(F.col("l_linenumber") % 3 != 0, F.date_add("pub", F.col("l_quantity").cast("int"))))
    return x.where(r.needs_refresh(F.col("pub"), F.col("last"), F.to_date(F.lit("1996-01-15")))).select("l_orderkey", "l_linenumber")


@query("""select event_id from (select event_id, ts, case when event_id % 4 = 0 then null else ts - to_seconds(event_id % 180) end as upd,
 case when event_id % 5 = 0 then null else value end as views, case when event_id % 10 = 0 then null else user_id end as comments from events)
 where (upd is null or ts >= upd + interval 1 minute) and (views is not null or comments is not null)""")
def dirty_rows(spark, d):
    e = table(spark, d, "events")
    upd = F.when(F.col("event_id") % 4 != 0, F.expr("ts - make_dt_interval(0, 0, 0, event_id % 180)"))
    views_, comments = F.when(F.col("event_id") % 5 != 0, F.col("value")), F.when(F.col("event_id") % 10 != 0, F.col("user_id"))
    return e.where(r.is_dirty(F.col("ts"), upd, views_, comments)).select("event_id")


@query(f"""with {THETA_SQL}, changes as (select user_id as k, max(value) as v from events group by 1)
 select document_id, topic_id, {q6('coalesce(v, topic_weight)')} as activity from theta left join changes on k = document_id""")
def activity_update(spark, d):
    from tidemark.functions.columns import q6

    changes = table(spark, d, "events").groupBy(F.col("user_id").alias("document_id")).agg(F.max("value").alias("activity"))
    target = views.theta(spark, d).withColumnRenamed("topic_weight", "activity")
    return r.merge_update(target, changes, "document_id").withColumn("activity", q6(F.col("activity")))


@query("""select event_id, case when value >= 75 then 'high' when value > 25 then 'medium' else 'low' end as band from events""")
def priority_bands(spark, d):
    return table(spark, d, "events").select("event_id", r.priority_band(F.col("value")).alias("band"))


@query("""select l_partkey % 7 as k, count(*) * 2000 as n, case when count(*) * 2000 > 10000000 then 5 when count(*) * 2000 > 1000000 then 3
 when count(*) * 2000 > 100000 then 2 else 1 end as shards from lineitem group by 1""")
def shards_mapping(spark, d):
    x = table(spark, d, "lineitem").groupBy((F.col("l_partkey") % 7).alias("k")).agg((F.count("*") * 2000).alias("n"))
    return x.withColumn("shards", r.shards_for_rows(F.col("n")))


@query("select event_id, event_type from events where event_id > 250 and event_id <= 250 + 5000")
def incremental_cursor(spark, d):
    return r.cursor_batch(table(spark, d, "events").select("event_id", "event_type"), "event_id", 250, 5000)


@query("select event_id from events where date '2024-01-20' - ts::date <= 5")
def recent_docs(spark, d):
    return table(spark, d, "events").where(F.datediff(F.to_date(F.lit("2024-01-20")), F.to_date("ts")) <= 5).select("event_id")


META = "select user_id % 7 as volume_days, event_type as meta_name, min(ts) as from_date, max(ts) as to_date, count(*) as n from events where user_id % 2 = {0} group by 1, 2"


@query(f"""with old as ({META.format(0)}), new as ({META.format(1)}) select *, timestamp '2024-02-01' as modified from new union all
 select *, null from old where not exists (select 1 from new where new.volume_days = old.volume_days and new.meta_name = old.meta_name)""")
def window_metadata(spark, d):
    """Upsert of the parameters of time windows."""
    part = lambda i: (
        table(spark, d, "events").where(F.col("user_id") % 2 == i).groupBy((F.col("user_id") % 7).alias("volume_days"), F.col("event_type").alias("meta_name"))
        .agg(F.min("ts").alias("from_date"), F.max("ts").alias("to_date"), F.count("*").alias("n"))
    )
    return r.upsert(part(0), part(1), ["volume_days", "meta_name"], F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz"))


@query("""select s_suppkey, case when n is not null and n > old then n else old end as views from (select s_suppkey, s_suppkey * 5 as old from supplier)
 left join (select l_suppkey, count(*) as n from lineitem where l_quantity > 40 group by 1) on l_suppkey = s_suppkey""")
def counter_update(spark, d):
    target = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") * 5).alias("views"))
    new = table(spark, d, "lineitem").where("l_quantity > 40").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("views"))
    return r.increased_only(target, new, "s_suppkey", "views")


@query("""with p as (select doc_id % 50 as account_id, doc_id, text, n_chars, timestamp '2024-01-01' + to_days(cast(doc_id % 30 as integer)) as datetime from documents where text <> ''),
 x as (select *, doc_id % 3 = 0 as known, account_id % 2 = 0 as had from p where account_id % 2 = 1 or datetime >= timestamp '2024-01-07')
 select account_id, 'Пост от ' || strftime(datetime, '%Y-%m-%d %H:%M:%S') || ': ' || substr(text, 1, 150) || case when length(text) > 150 then '...' else '' end as title,
 datetime, account_id || '-' || doc_id as url, n_chars::bigint as num_views, case when known then 'update' else 'insert' end as action from x
 where not known or (had and datetime < timestamp '2024-01-10')""")
def post_documents(spark, d):
    """Documents as messages of channels: what a run inserts and updates."""
    messages = table(spark, d, "documents").select(
        (F.col("doc_id") % 50).alias("account_id"), F.col("doc_id").alias("id"), "text", F.col("n_chars").alias("views"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(doc_id % 30 as int))").alias("date"),
    )
    rows = posts.channel(messages)
    stored_urls = rows.where(F.substring_index("url", "-", -1).cast("long") % 3 == 0)
    last = rows.select("account_id").distinct().where("account_id % 2 = 0").withColumn("last", F.expr("timestamp_ntz'2024-01-10 00:00:00'"))
    return posts.planned(rows, stored_urls, last).select("account_id", "title", "datetime", "url", "num_views", "action")
