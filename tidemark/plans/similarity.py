"""Queries of co-occurrence, mapping, clustering, vectors and places."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.columns import clean, cleaned_words, q6, words
from tidemark.operators import clusters as cl, units
from tidemark.operators import cosine, density, geo, units
from tidemark.operators import similarity as sm
from tidemark.operators.topics import tfidf
from tidemark.plans import views
from tidemark.plans.topics import rounded, s6
from tidemark.plans.views import DOC_WORDS_SQL, THETA_SQL, WORDS_SQL, docs, table
from tidemark.scratch import stored

QUERIES, ORACLES = {}, {}


def query(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


#: The dictionary filter: words of at least this share of the documents.
VOCAB = "vocab as (select word from doc_words group by 1 having count(*) >= {0} * (select count(*) from documents))"
COOC = """x as (select doc_id, word, tf from doc_words where word in (select word from vocab)),
 cooc as (select a.word as w1, b.word as w2, cast(sum(a.tf * b.tf) as bigint) as value from x a join x b using (doc_id) where a.word <= b.word group by 1, 2)"""
DIST = """sym as (select w1 as row, w2 as col, value::double as v from cooc union all select w2, w1, value::double from cooc where w1 <> w2),
 norm as (select row, sqrt(sum(v * v)) as n from sym group by 1), dot as (select a.row as a, b.row as b, sum(a.v * b.v) as dot from sym a join sym b using (col) where a.row < b.row group by 1, 2),
 dist as (select a, b, 1 - dot / (x.n * y.n) as distance from dot join norm x on x.row = a join norm y on y.row = b)"""


def _frequent(spark, d, share):
    """(words of the documents, those that ``share`` of the documents hold)."""
    counted = stored(views.doc_words(spark, d), "words")
    n = docs(spark, d).agg(F.count("*").alias("n"))
    known = counted.groupBy("word").agg(F.count("*").alias("df")).crossJoin(F.broadcast(n)).where(F.col("df") >= share * F.col("n"))
    return counted, known.select("word")


def _distances(spark, d, share=0.1):
    c = sm.cooccurrence(*_frequent(spark, d, share), diagonal=True)
    return stored(sm.cosine_distances(sm.symmetric(c)), "distances")


@query(f"with {DOC_WORDS_SQL}, {VOCAB.format(0.05)}, {COOC} select * from cooc where w1 < w2")
def cooccurrence(spark, d):
    return sm.cooccurrence(*_frequent(spark, d, 0.05))


@query(f"with {DOC_WORDS_SQL}, {VOCAB.format(0.1)}, {COOC}, {DIST} select a, b, {s6('distance')} from dist")
def cosine_distance(spark, d):
    return rounded(_distances(spark, d), "distance")


#: Sources are the customers of the orders; the largest thousand have a vector.
MOST_SOURCES = 1000
SOURCE_SQL = f"""{THETA_SQL}, every as (select o_custkey as source, topic_id, sum(topic_weight) as weight, count(*) as n from theta join orders on o_orderkey = document_id where o_custkey is not null group by 1, 2),
 largest as (select source from every group by 1 order by sum(n) desc, source limit {MOST_SOURCES}), source_topics as (select * from every semi join largest using (source))"""


def _source_topics(spark, d):
    by = table(spark, d, "orders").select(F.col("o_orderkey").alias("document_id"), F.col("o_custkey").alias("source"))
    return stored(sm.source_vectors(views.theta(spark, d).join(by, "document_id"), MOST_SOURCES), "vectors")


@query(f"""with {SOURCE_SQL} select source, {', '.join(s6(f"coalesce(sum(weight) filter (topic_id = 'topic_{i}'), 0)", f't{i}') for i in range(20))} from source_topics group by 1""")
def source_topic_matrix(spark, d):
    """The largest sources' vectors over the topics."""
    m = _source_topics(spark, d).groupBy("source").pivot("topic_id", [f"topic_{i}" for i in range(20)]).agg(F.sum("weight")).fillna(0.0)
    return rounded(m.toDF("source", *(f"t{i}" for i in range(20))), *(f"t{i}" for i in range(20)))


@query(f"""with {SOURCE_SQL}, norm as (select source, sqrt(sum(weight * weight)) as n from source_topics group by 1),
 dot as (select a.source as a, b.source as b, sum(a.weight * b.weight) as dot from source_topics a join source_topics b using (topic_id) where a.source < b.source group by 1, 2)
 select a, b, {s6('dot / (x.n * y.n)', 'similarity')} from dot join norm x on x.source = a join norm y on y.source = b where round(dot / (x.n * y.n), 9) >= 0.85""")
def similar_sources(spark, d):
    """Pairs of sources of cosine 0.85 or more."""
    v = _source_topics(spark, d).toDF("row", "col", "v")
    return rounded(cosine.similar_pairs(v, 0.85 - 1e-8).where(F.round("similarity", 9) >= 0.85), "similarity")


# Mapping of topics between two windows -----------------------------------------------------------------------------


#: Words of a topic, the heaviest, without hyphens and of two characters or more.
TOPIC_WORDS = 100


def _phi_of(spark, d, rest):
    """Topics' words of one window; a word weighs by in how few of the window's lists it stands, over its list's greatest."""
    w = views.doc_words(spark, d).where(F.col("doc_id") % 2 == rest).withColumn("word", F.replace("word", F.lit("-"), F.lit(""))).where("length(word) >= 2").groupBy("topic_id", "word").agg(F.sum("tf").alias("tf"))
    rank = F.row_number().over(Window.partitionBy("topic_id").orderBy(F.desc("tf"), "word"))
    listed = w.withColumn("rank", rank).where(F.col("rank") <= TOPIC_WORDS).select("topic_id", "word", F.lit(1).alias("tf"))
    return tfidf(stored(listed, "listed")).select("topic_id", "word", F.col("relative").alias("w"))


def _windows(spark, d):
    """(word cells, words of the first window's topics, of the second's)."""
    one, two = (stored(_phi_of(spark, d, i), "window") for i in (0, 1))
    tagged = one.select(F.concat(F.lit("a"), "topic_id").alias("t"), "word").union(two.select(F.concat(F.lit("b"), "topic_id"), "word"))
    x = tagged.select(F.col("t").alias("doc_id"), "word", F.lit(1).alias("tf"))
    c = sm.cooccurrence(x, x, diagonal=True)
    return stored(sm.word_cells(one, two, cl.both_ways(sm.cosine_distances(sm.symmetric(c)))), "cells"), one, two


def _phi_sql(name: str, rest: int) -> str:
    return f"""{name}_list as (select topic_id, word from (select *, row_number() over (partition by topic_id order by tf desc, word) as rank
 from (select topic_id, word, cast(sum(tf) as bigint) as tf from (select topic_id, doc_id, replace(word, '-', '') as word, tf from doc_words) where doc_id % 2 = {rest} and length(word) >= 2 group by 1, 2)) where rank <= {TOPIC_WORDS}),
 {name}_idf as (select topic_id, word, ln((1 + (select count(distinct topic_id) from {name}_list)) / (1 + count(*) over (partition by word))) + 1 as idf from {name}_list),
 {name} as (select topic_id, word, idf / max(idf) over (partition by topic_id) as w from {name}_idf)"""


CELLS = f"""{DOC_WORDS_SQL}, {_phi_sql('one', 0)}, {_phi_sql('two', 1)}, x as (select 'a' || topic_id as doc_id, word, 1 as tf from one union all select 'b' || topic_id, word, 1 from two),
 cooc as (select a.word as w1, b.word as w2, count(*) as value from x a join x b using (doc_id) where a.word <= b.word group by 1, 2), {DIST},
 cells as (select one.topic_id as t1, two.topic_id as t2, one.word as i, two.word as j, one.w as rw, two.w as cw,
 round(1 - case when one.word = two.word then 0.0 else coalesce(distance, 1.0) end, 12) as s from one cross join two left join dist on a = least(one.word, two.word) and b = greatest(one.word, two.word))"""
SCORES = f"""{CELLS}, r as (select *, row_number() over (partition by t1, t2, i order by s desc, j) as ri, row_number() over (partition by t1, t2, j order by s desc, i) as rj from cells),
 l as (select *, round(avg(case when ri = 1 then s end) over (partition by t1, t2) - stddev_pop(case when ri = 1 then s end) over (partition by t1, t2), 12) as li,
 round(avg(case when rj = 1 then s end) over (partition by t1, t2) - stddev_pop(case when rj = 1 then s end) over (partition by t1, t2), 12) as lj from r),
 t as (select t1, t2, sum(case when s >= 0.97 then rw * cw * (s - 0.8) else 0 end) as true_part,
 sum(case when ri = 1 and s > li then rw * cw * s else 0 end + case when rj = 1 and s > lj then rw * cw * s else 0 end) as whole from l group by 1, 2),
 scores as (select t1, t2, case when whole > 0 then true_part / whole else 0 end as score from t)"""


@query(f"""with {CELLS}, g as (select t1, t2, sum(rw * cw * s) as total, sum(case when s >= 0.5 then rw * cw * s else 0 end) as part from cells group by 1, 2)
 select t1, t2, {s6('case when total > 0 then part / total else 0 end', 'score')} from g""")
def mutual_similarity(spark, d):
    return rounded(sm.mutual_similarity(*_windows(spark, d), 0.5), "score")


@query(f"with {SCORES} select t1, t2, {s6('score')} from scores")
def topic_mapping(spark, d):
    return rounded(sm.semantic_mapping(*_windows(spark, d)), "score")


#: The thresholds of a mapping; the second window's first day and the first window's last bound the documents compared.
THRESHOLDS = [0.3, 0.4, 0.5, 0.6, 0.7, 0.8]
SECOND_FROM, FIRST_TO = "1995-01-01", "1996-12-31"
MAPPED = f"{SCORES}, th as (select unnest({THRESHOLDS})::double as threshold), mapped as (select threshold, t1, t2 from scores, th where {views.q6('score')} > threshold)"


def _mapped(spark, d):
    cells, one, two = _windows(spark, d)
    return stored(sm.at_thresholds(rounded(sm.semantic_mapping(cells, one, two), "score"), THRESHOLDS), "mapped"), one, two


@query(f"""with {MAPPED} select threshold, t1, t2, coalesce((select string_agg(word, ' ' order by word) from one where topic_id = t1 and word not in (select word from two where topic_id = t2)), '') as delta_words,
 (select count(*) from one where topic_id = t1 and word not in (select word from two where topic_id = t2)) as delta_count from mapped""")
def mapping_delta(spark, d):
    """What the first window's topic says and the second's, to which it is mapped, doesn't."""
    x = sm.delta_words(*_mapped(spark, d))
    return x.select("threshold", "t1", "t2", F.array_join("delta_words", " ").alias("delta_words"), F.col("delta_count").cast("long").alias("delta_count"))


@query(f"""with {MAPPED}, {views.THETA_DT_SQL}, td as (select document_id, topic_id from theta_dt where topic_weight >= 0.05 and datetime >= timestamp '{SECOND_FROM}' and datetime <= timestamp '{FIRST_TO}'),
 n as (select topic_id, count(*) as n from td group by 1),
 b as (select a.topic_id as t1, b.topic_id as t2, count(*) as c from td a join td b using (document_id) group by 1, 2),
 j as (select threshold, t1, t2, case when coalesce(n1.n, 0) + coalesce(n2.n, 0) = 0 then 0.0 else coalesce(c, 0) / (coalesce(n1.n, 0) + coalesce(n2.n, 0) - coalesce(c, 0)) end as j from mapped left join b using (t1, t2) left join n n1 on n1.topic_id = t1 left join n n2 on n2.topic_id = t2),
 p as (select threshold, count(distinct t1) / 20 as coverage, {views.q6('avg(j)')} as mj from j group by 1)
 select threshold, {s6('coalesce(coverage, 0)', 'coverage')}, {s6('coalesce(mj, 0)', 'mean_jaccard')}, {s6('(mj - min(mj) over ()) / case when max(mj) over () = min(mj) over () then 1 else max(mj) over () - min(mj) over () end', 'scaled')} from th left join p using (threshold)""")
def mapping_validation(spark, d):
    """Every threshold's share of mapped topics and their documents' overlap inside the dates that both windows have."""
    theta = stored(views.theta_dt(spark, d).select("document_id", "topic_id", "topic_weight", "datetime"), "theta")
    out = sm.validate_mapping(_mapped(spark, d)[0], theta, theta, 20, THRESHOLDS, (SECOND_FROM, FIRST_TO))
    return rounded(out, "coverage", "mean_jaccard", "scaled")


# Clusters -------------------------------------------------------------------------------------------------------------

SOURCES = """v as (select user_id as row, event_type as col, count(*)::double as v from events group by 1, 2), norm as (select row, sqrt(sum(v * v)) as n from v group by 1),
 dot as (select a.row as a, b.row as b, sum(a.v * b.v) as dot from v a join v b using (col) where a.row < b.row group by 1, 2),
 dist as (select a, b, floor((1 - dot / (x.n * y.n)) * 1e9 + 0.5) / 1e9 as distance from dot join norm x on x.row = a join norm y on y.row = b)"""


#: Directions of sources whose pairs make a table; more are compared in blocks, which takes columns up to this number.
MOST_PAIRED, MOST_COLUMNS = 1000, 4096


@query(f"""with recursive {SOURCES}, near as (select a, b from dist where distance <= 0.01), sides as (select a, b from near union all select b, a from near),
 core as (select a as point from sides group by 1 having count(*) + 1 >= 4), links as (select a, b from sides where a in (select point from core) and b in (select point from core)),
 reach(p, q) as (select point, point from core union select p, b from reach join links on a = q), comp as (select p as point, min(q) as c from reach group by 1),
 numbered as (select c, row_number() over (order by c) - 1 as label from (select distinct c from comp)), cores as (select point, label from comp join numbered using (c)),
 border as (select a as point, min(label) as label from sides join cores on point = b group by 1)
 select row as point, cast(coalesce(cores.label, border.label, -1) as bigint) as label from norm left join cores on cores.point = row left join border on border.point = row""")
def source_dbscan(spark, d):
    """An event without a type is like no other: it counts in its source's length alone, as in the SQL."""
    v = table(spark, d, "events").groupBy(F.col("user_id").alias("row"), F.col("event_type").alias("type")).agg(F.count("*").cast("double").alias("v"))
    v = stored(v, "vectors")
    nobody = v.where("row is null").select(F.col("row").alias("point"), F.lit(-1).cast("long").alias("label")).distinct()
    v = v.where("row is not null").select("row", F.struct("type", F.when(F.col("type").isNull(), F.col("row")).alias("own")).alias("col"), "v")
    equal = stored(cl.equal_rows(v), "equal")
    points = stored(equal.groupBy("point").agg(F.count("*").alias("weight")), "points")
    v = v.join(points.select(F.col("point").alias("row")), "row", "left_semi")
    columns = [r["type"] for r in v.select("col.type").where("type is not null").distinct().orderBy("type").limit(MOST_COLUMNS + 1).collect()]
    if points.count() > MOST_PAIRED and len(columns) <= MOST_COLUMNS:
        number = F.broadcast(spark.createDataFrame([(c, i) for i, c in enumerate(columns)], "type string, i int"))
        x = v.select("row", "col.type", "v").join(number, "type", "left").groupBy(F.col("row").alias("point"))
        x = x.agg(F.map_from_entries(F.collect_list(F.when(F.col("i").isNotNull(), F.struct("i", "v")))).alias("m"), F.coalesce(F.sum(F.when(F.col("i").isNull(), F.col("v") * F.col("v"))), F.lit(0.0)).alias("own"))
        every = F.sequence(F.lit(0), F.lit(len(columns) - 1)) if columns else F.array().cast("array<int>")
        x = x.select("point", F.transform(every, lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("vec"), "own")
        labels = density.dbscan(x.join(points, "point"), 0.01, 4)
    else:
        pairs = cosine.similar_pairs(v, 0.99 - 1e-8)
        dist = pairs.select("a", "b", (F.floor((1 - F.col("similarity")) * 1e9 + 0.5) / 1e9).alias("distance"))
        labels = cl.dbscan(dist, points, 0.01, 4)
    out = equal.join(labels, "point").select(F.col("row").alias("point"), F.col("label").cast("long").alias("label"))
    return out.unionByName(nobody)


#: The radii and least numbers of the grid.
GRID = [(e / 10, n) for e in range(1, 11) for n in range(1, 10)]


@query(f"""with recursive {SOURCE_SQL}, norm as (select source as row, sqrt(sum(weight * weight)) as n from source_topics group by 1),
 dot as (select a.source as a, b.source as b, sum(a.weight * b.weight) as dot from source_topics a join source_topics b using (topic_id) where a.source < b.source group by 1, 2),
 dist as (select x.row as a, y.row as b, floor((1 - coalesce(dot, 0) / (x.n * y.n)) * 1e9 + 0.5) / 1e9 as distance from norm x join norm y on x.row < y.row left join dot on a = x.row and b = y.row),
 eps as (select unnest(range(1, 11)) as i), leasts as (select unnest(range(1, 10)) as least), grid as (select i, least, (i - 1) * 9 + least - 1 as cell from eps, leasts),
 pairs as (select a, b, cast(greatest(ceil(distance * 10), 1) as bigint) as i from dist union all select b, a, cast(greatest(ceil(distance * 10), 1) as bigint) from dist),
 hist as (select a as point, i, count(*) as n from pairs where i <= 10 group by 1, 2), near as (select row as point, eps.i, coalesce(sum(hist.n), 0) + 1 as n from norm cross join eps left join hist on point = row and hist.i <= eps.i group by 1, 2),
 core as (select i, least, cell, point from near join grid using (i) where n >= least),
 links as (select x.cell, a, b from pairs p join core x on x.i >= p.i and x.point = a join core y on y.cell = x.cell and y.point = b where b < a),
 reach(cell, point, c) using key (cell, point) as (select cell, point, point from core union
  (select r.cell, r.point, min(t.c) from (select cell, a as point, b as other from links union all select cell, b, a from links) l join reach t on t.cell = l.cell and t.point = l.other join recurring.reach r on r.cell = l.cell and r.point = l.point
   where t.c < r.c group by 1, 2)),
 numbered as (select cell, point, dense_rank() over (partition by cell order by c) - 1 as label from reach),
 border as (select g.cell, p.a as point, min(label) as label from pairs p join grid g on g.i >= p.i join near x on x.point = p.a and x.i = g.i and x.n < g.least join numbered y on y.cell = g.cell and y.point = p.b group by 1, 2)
 select cast(grid.cell as bigint) as cell, row as point, cast(coalesce(x.label, y.label, -1) as bigint) as label from norm cross join grid left join numbered x on x.cell = grid.cell and x.point = row
 left join border y on y.cell = grid.cell and y.point = row""")
def source_dbscan_grid(spark, d):
    """The sources' clusterings over all radii and least numbers, as rows. Weights are not negative, so that every pair that
    shares a topic is within 1, and two sources without a common topic are at 1."""
    v = _source_topics(spark, d).toDF("row", "col", "v")
    pairs = cosine.similar_pairs(v, 0.1 - 1e-8).select("a", "b", (1 - F.col("similarity")).alias("distance"))
    pairs = stored(pairs.withColumn("distance", F.floor(F.col("distance") * 1e9 + 0.5) / 1e9), "distances")
    out = cl.dbscan_grid(pairs, v.select(F.col("row").alias("point")).distinct(), GRID)
    return out.select(F.col("cell").cast("long").alias("cell"), "point", F.col("label").cast("long").alias("label"))


@query(None)
def clots(spark, d):
    found = cl.clots(_distances(spark, d), 0.3, 0.4)
    return found.select("seed", F.array_join("members", " ").alias("members"), F.size("members").alias("n"))


HOODS = f"""{DOC_WORDS_SQL}, {VOCAB.format(0.1)}, {COOC}, {DIST}, d2 as (select a, b, distance from dist union all select b, a, distance from dist union all select w, w, 0.0 from (select a as w from dist union select b from dist)),
 hood as (select a as seed, list_sort(list(distinct b)) as members from d2 where distance <= 0.02 group by 1), sets as (select distinct members from hood where len(members) >= 2)"""


def _sets(distances):
    return cl.unique(cl.neighbourhoods(distances, 0.02), 2)


@query(f"with {HOODS} select array_to_string(members, ' ') as members, len(members) as n from sets")
def clot_unique(spark, d):
    return _sets(_distances(spark, d)).select(F.array_join("members", " ").alias("members"), F.size("members").cast("long").alias("n"))


BOUND = f"""{HOODS}, s as (select row_number() over (order by array_to_string(members, ' ')) as id, members from sets),
 links as (select x.id as a, y.id as b from s x join s y on x.id <> y.id and 1 - len(list_intersect(x.members, y.members)) / least(len(x.members), len(y.members)) < 0.5),
 reach(p, q) as (select id, id from s union select p, b from reach join links on a = q), comp as (select p as id, min(q) as c from reach group by 1),
 m as (select distinct c, unnest(members) as member from s join comp using (id)), named as (select c, string_agg(member, ' ' order by member) as cluster from m group by 1),
 bound as (select cluster, member from m join named using (c))"""


def _bound(spark, d):
    """(clusters, distances, both ways): the distances are stored, and made once."""
    distances = _distances(spark, d)
    return stored(cl.bind(_sets(distances), 0.5), "bound"), cl.both_ways(distances).toDF("a", "b", "v")


@query(f"with recursive {BOUND} select cluster, member from bound")
def clot_binding(spark, d):
    return cl.bind(_sets(_distances(spark, d)), 0.5)


FULL = f"""{BOUND}, sums as (select cluster, d2.a as object, sum(distance) as s from bound join d2 on d2.b = member group by 1, 2),
 inner_w as (select cluster, object, case when max(s) over (partition by cluster) > 0 then 1 - s / max(s) over (partition by cluster) else 1 end as weight
 from sums where exists (select 1 from bound where bound.cluster = sums.cluster and member = object)),
 full_w as (select cluster, object, case when max(s) over (partition by cluster) > 0 then 1 - s / max(s) over (partition by cluster) else 1 end as weight from sums)"""


@query(f"with recursive {FULL} select cluster, object, {s6('weight')} from inner_w")
def clot_weights(spark, d):
    return rounded(cl.weights(*_bound(spark, d), inverse=True), "weight")


@query(f"""with recursive {FULL}, k as (select cluster, object, {views.q6('weight')} as weight, case when exists (select 1 from bound b where b.cluster = full_w.cluster and member = object)
 then 'key' else 'extra' end as kind from full_w), r as (select *, row_number() over (partition by cluster, kind order by weight desc, object) as rank from k)
 select cluster, kind, object, rank, weight from r where rank <= 3""")
def clot_key_objects(spark, d):
    bound, cells = _bound(spark, d)
    w = rounded(cl.weights(bound, cells, inverse=True, full=True), "weight")
    return cl.key_objects(w, bound, 3).withColumn("rank", F.col("rank").cast("long"))


# Vectors --------------------------------------------------------------------------------------------------------------

DOTS = "list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1]::double * z[2]::double))"


@query(f"""with q as (select vec_id as query_id, embedding as q, sqrt({DOTS.format(a='embedding', b='embedding')}) as nq from embeddings),
 x as (select query_id, vec_id, round({DOTS.format(a='q', b='embedding')} / (nq * sqrt({DOTS.format(a='embedding', b='embedding')})), 9) as similarity from embeddings, q where vec_id <> query_id),
 r as (select *, row_number() over (partition by query_id order by similarity desc, vec_id) as rank from x) select query_id, vec_id, {s6('similarity')}, rank from r where rank <= 5""")
def embedding_cosine(spark, d):
    e = table(spark, d, "embeddings")
    x = sm.nearest(e, e, 5)
    s = F.col("similarity")
    x = x.withColumn("similarity", F.when(F.isnan(s), s).otherwise(q6(s)))
    return x.withColumn("rank", F.col("rank").cast("long"))


@query(f"""with x as (select label, unnest(embedding) as v, unnest(range(len(embedding))) as pos from embeddings)
 select label, cast(pos as int) as pos, {s6('avg(v::double)', 'average')}, {s6('max(v)', 'greatest')} from x group by 1, 2""")
def embedding_pool(spark, d):
    return rounded(sm.pool(table(spark, d, "embeddings"), "label"), "average", "greatest")


@query("""with x as (select conv_id, turn, string_split(text, ' ') as w from conversations), y as (select conv_id, turn, unnest(w) as word, unnest(range(len(w))) as pos from x)
 select conv_id, turn, cast(pos as int) as pos, word from y where word <> ''""")
def embedding_flatten(spark, d):
    x = table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("pos", "word"))
    return x.where("word <> ''")


UNITS_SQL = """with t as (select conv_id, turn, string_split(text, '. ') as ss from conversations where text is not null), s as (select conv_id, turn, unnest(ss) as s, generate_subscripts(ss, 1) as si from t),
 w as (select conv_id, turn, si, list_filter(string_split(s, ' '), lambda x: x <> '') as ws from s),
 p as (select conv_id, turn, si, wi, word, unnest(range(1, length(word) + 1, 4)) as place from (select conv_id, turn, si, unnest(ws) as word, generate_subscripts(ws, 1) as wi from w)),
 v as (select *, substr(word, place, 4) as piece from p),
 words as (select conv_id, turn, si, wi, string_agg(piece, '' order by place) as unit, avg(length(piece)) as a, avg(ascii(piece)) as b from v group by 1, 2, 3, 4),
 edges as (select *, row_number() over (partition by conv_id, turn, si order by wi) as up, row_number() over (partition by conv_id, turn, si order by wi desc) as down from words),
 sents as (select conv_id, turn, si, avg(a) as a, avg(b) as b, max(a) as ma, max(b) as mb from edges where up > 1 and down > 1 group by 1, 2, 3),
 n as (select conv_id, turn, cast(len(ss) as int) as sentences from t)"""


@query(f"""{UNITS_SQL}, texts as (select conv_id, turn, {', '.join(f"avg({c}) as {c}" for c in ('a', 'b', 'ma', 'mb'))} from sents group by 1, 2)
 select conv_id, turn, sentences, {', '.join(s6(c) for c in ('a', 'b', 'ma', 'mb'))} from n left join texts using (conv_id, turn)""")
def unit_pooling(spark, d):
    """Vectors of pieces (length, code of the first letter) pooled to words, sentences and texts."""
    pieces = lambda w: F.transform(F.sequence(F.lit(1), F.length(w), F.lit(4)), lambda i: F.struct(
        F.concat(F.when(i == 1, "").otherwise(units.GOES_ON), F.substring(w, i, F.lit(4))).alias("unit"),
        F.array(F.length(F.substring(w, i, F.lit(4))).cast("double"), F.ascii(F.substring(w, i, F.lit(1))).cast("double")).alias("vector"),
    ))
    edge = lambda name: F.array(F.struct(F.lit(name).alias("unit"), F.array(F.lit(0.0), F.lit(0.0)).alias("vector")))
    one = lambda s: F.concat(edge("[CLS]"), F.flatten(F.transform(F.filter(F.split(s, " "), lambda w: w != ""), pieces)), edge("[SEP]"))
    x = table(spark, d, "conversations").where("text is not null").select("conv_id", "turn", F.transform(F.split("text", r"\. "), one).alias("pieces"))
    x = units.to_sentences(units.to_words(x.withColumn("sentences", F.size("pieces")), "pieces"), "pieces", "Average+Max")
    x = units.to_text(x, "pieces")
    each = [F.get(F.col("pieces.vector"), F.lit(i)).alias(c) for i, c in enumerate(("a", "b", "ma", "mb"))]
    return rounded(x.select("conv_id", "turn", "sentences", *each), "a", "b", "ma", "mb")


# Places ---------------------------------------------------------------------------------------------------------------


@query(f"""with g as (select item_id as location_id, case item_id % 3 when 0 then 'area' when 1 then 'district' else 'locality' end as level,
 array_to_string(list_slice({WORDS_SQL}, 1, 3), '_') as gram from benchmark), t as (select doc_id, {WORDS_SQL} as t from documents),
 n as (select doc_id, t[i] || '_' || t[i+1] || '_' || t[i+2] as gram from (select doc_id, t, unnest(generate_series(1, len(t) - 2)) as i from t))
 select doc_id, location_id, level, count(*) as tf from n join g using (gram) group by 1, 2, 3""")
def doc_locations(spark, d):
    g = table(spark, d, "benchmark").select(
        F.col("item_id").alias("id"), F.expr("case item_id % 3 when 0 then 'area' when 1 then 'district' else 'locality' end").alias("level"),
        F.array_join(F.slice(words(clean(F.col("text"))), 1, 3), " ").alias("name"),
    )
    return geo.phrase_hits(docs(spark, d), g, ["text"])


#: A document's four fields: its text, its first and last sentence-like parts, and its source.
FIELDS = ["text", "title", "tail", "source"]
FIELD_SQL = "select doc_id, text, substr(text, 1, 150) as title, right(text, 150) as tail, source from documents where text is not null"


@query(f"""with g as (select item_id as location_id, case item_id % 3 when 0 then 'area' when 1 then 'district' else 'locality' end as level,
 array_to_string(list_slice({WORDS_SQL}, 1, cast(item_id % 8 + 1 as int)), '_') as gram from benchmark), f as ({FIELD_SQL}),
 t as (select doc_id, row_number() over () as f, {WORDS_SQL} as t from (select doc_id, unnest([text, title, tail, source]) as text from f)),
 k as (select doc_id, f, unnest(t) as w, generate_subscripts(t, 1) as i from t),
 leads as (select *, {', '.join(f'lead(w, {j}) over (partition by f order by i) as w{j}' for j in range(1, 8))} from k),
 n as (select doc_id, unnest([{', '.join(" || '_' || ".join(['w', *(f'w{j}' for j in range(1, n))]) for n in range(1, 9))}]) as gram from leads where w in (select split_part(gram, '_', 1) from g)),
 h as (select doc_id, location_id, level, count(*) as tf from n join g using (gram) where gram <> '' group by 1, 2, 3),
 l as (select doc_id, cast(sum(len(t)) as bigint) as n_words from t group by 1), s as (select count(*) as n_docs, avg(n_words) as mean_words from l),
 df as (select location_id, count(distinct doc_id) as df from h group by 1), v as (select l_orderkey as doc_id, (sum(l_quantity) % 7) / 2 as value from lineitem group by 1)
 select doc_id, location_id, level, tf, {s6('ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n_words / mean_words))', 'weight')}, nullif(value, 0) as value
 from h join df using (location_id) join l using (doc_id) cross join s left join v using (doc_id)""")
def location_scores(spark, d):
    """Places of one to eight words in four fields, weighted by BM25, with the documents' values; 0 is no value."""
    name = F.slice(cleaned_words(F.col("text")), 1, (F.col("item_id") % 8 + 1).cast("int"))
    g = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.expr("case item_id % 3 when 0 then 'area' when 1 then 'district' else 'locality' end").alias("level"), F.array_join(name, " ").alias("name"))
    x = docs(spark, d).where("text is not null").select("doc_id", "text", F.substring("text", 1, 150).alias("title"), F.expr("right(text, 150)").alias("tail"), "source")
    hits = stored(geo.phrase_hits(x, g, FIELDS), "hits")
    lengths = x.select("doc_id", sum((F.size(cleaned_words(F.col(f))) for f in FIELDS), F.lit(0)).cast("long").alias("n_words"))
    n = lengths.agg(F.count("*").alias("n_docs"), F.avg("n_words").alias("mean_words"))
    values = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg((F.sum("l_quantity") % 7 / 2).alias("value"))
    return rounded(geo.with_scores(geo.bm25(hits, lengths, n), values), "weight")
