"""Queries of topic dynamics, topic words and expert criteria."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import q6
from tidemark.operators import criteria as cr
from tidemark.operators import dynamics as dy
from tidemark.operators import topics as tp
from tidemark.operators.quantiles import quantiles
from tidemark.plans import views
from tidemark.scratch import stored
from tidemark.plans.views import DOC_WORDS_SQL, EVAL_SQL, PHI_SQL, THETA_DT_SQL, THETA_SQL, docs

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return keep


def s6(x: str, name: str | None = None) -> str:
    return f"{views.q6(x)} as {name or x}"


def rounded(df, *cols: str):
    return df.select(*(q6(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns))


def _series_sql(step: str) -> str:
    day = "datetime::date" if step == "day" else f"date_trunc('{step}', datetime)::date"
    return (
        THETA_DT_SQL
        + f""", per as (select topic_id, {day} as day, sum(topic_weight) as weight, count(*) as n from theta_dt
 where topic_weight >= 0.05 and datetime >= timestamp '1990-01-01' group by 1, 2),
 total as (select day, sum(weight) as tw, sum(n) as tn from per group by 1), span as (select topic_id, min(day) as a, max(day) as z from per group by 1),
 days as (select topic_id, unnest(generate_series(a, z, interval 1 {step}))::date as day from span),
 series as (select topic_id, day, coalesce(weight, 0) as weight, coalesce(n, 0) as n,
 case when coalesce(tw, 0) <> 0 then coalesce(weight, 0) / tw else coalesce(weight, 0) end as weight_share,
 case when coalesce(tn, 0) <> 0 then coalesce(n, 0) / tn else 0 end as n_share from days left join per using (topic_id, day) left join total using (day))"""
    )


def stats_sql(step: str) -> str:
    return (
        _series_sql(step)
        + """, ch as (select *, abs(weight_share - lead(weight_share) over (partition by topic_id order by day)) as c from series),
 stats as (select topic_id, count(*) as steps, avg(weight_share) as weight_mean, case when min(weight_share) <= 0 then 0.0
 else exp(avg(case when weight_share > 0 then ln(weight_share) end)) end as weight_geom_mean, stddev_pop(weight_share) as weight_std,
 stddev_pop(c) as weight_change_std, median(c) as weight_change_median from ch group by 1 having count(*) >= 2)"""
    )


PERIODS_SQL = (
    stats_sql("month")
    + """, x as (select topic_id, day, weight_share, weight_mean, weight_std, row_number() over (partition by topic_id order by day) - 1 as i,
 sign(round(weight_share, 12) - round(weight_geom_mean, 12)) as side from series join stats using (topic_id)),
 y as (select *, coalesce(last_value(nullif(side, 0) ignore nulls) over (partition by topic_id order by day), -1) > 0 as up, max(i) over (partition by topic_id) as last from x),
 z as (select *, up <> coalesce(lag(up) over (partition by topic_id order by day), false) as flip from y),
 r as (select *, sum(cast(flip as int)) over (partition by topic_id order by day) as run from z),
 periods as (select topic_id, min(i) as period_start, count(*) as period_length, max(weight_share) as period_max from r where up group by topic_id, run
 having max(i) < max(last) and max(weight_share) - max(weight_mean) > 0.5 * max(weight_std))"""
)


def series(spark, d, step="day"):
    return dy.series(views.theta_dt(spark, d), since="1990-01-01", step=step)


@query(f"with {_series_sql('day')} select topic_id, day, {s6('weight')}, n, {s6('weight_share')}, {s6('n_share')} from series")
def topic_dynamics(spark, d):
    return rounded(series(spark, d), "weight", "weight_share", "n_share")


@query(f"""with {stats_sql('month')} select topic_id, steps, {s6('weight_mean')}, {s6('weight_geom_mean')}, {s6('weight_std')}, {s6('weight_change_std')},
 {s6('weight_change_median')} from stats""")
def topic_stats(spark, d):
    st = dy.stats(series(spark, d, "month"))
    return rounded(st, "weight_mean", "weight_geom_mean", "weight_std", "weight_change_std", "weight_change_median")


@query(f"""with {_series_sql('month')}, w as (select topic_id, day, avg(weight_share) over (partition by topic_id order by day rows between 2 preceding and 2 following) as smoothed from series)
 select topic_id, day, {s6('smoothed')} from w""")
def topic_smooth(spark, d):
    x = dy.smooth(series(spark, d, "month"), 2).select("topic_id", "day", F.col("weight_share").alias("smoothed"))
    return rounded(x, "smoothed")


@query(f"with {PERIODS_SQL} select topic_id, period_start, period_length, {s6('period_max')} from periods")
def topic_periods(spark, d):
    return rounded(dy.periods(series(spark, d, "month")), "period_max")


@query(f"""with {PERIODS_SQL}, p as (select topic_id, avg(period_length) as pm, avg(period_max) as px from periods group by 1), m as (select * from stats left join p using (topic_id))
 select {s6('median(pm)', 'period_median')}, {s6('stddev_pop(pm)', 'period_std')}, {s6('median(px)', 'period_maxes_mean_median')}, {s6('stddev_pop(px)', 'period_maxes_mean_std')},
 {s6('median(weight_std)', 'weight_std_median')}, {s6('stddev_pop(weight_std)', 'weight_std_std')} from m""")
def topic_model_stats(spark, d):
    s = series(spark, d, "month")
    x = dy.model_stats(dy.stats(s), dy.period_stats(dy.periods(s)))
    return rounded(x, *x.columns)


RANKED = "select *, row_number() over (partition by topic_id order by weight desc, word) as rank from phi where weight > {0}"


@query(f"""with {PHI_SQL}, r as ({RANKED.format(1e-4)}) select topic_id, string_agg(word, ', ' order by rank) filter (rank <= 5) as name, count(*) as n_words,
 string_agg(word, ' ' order by rank) as words, {s6('sum(weight)', 'mass')} from r where rank <= 100 group by 1""")
def topic_top_words(spark, d):
    x = tp.top_words(views.phi(spark, d))
    words = F.array_join(F.transform("topic_words", lambda w: w["word"]), " ")
    mass = F.aggregate("topic_words", F.lit(0.0), lambda a, w: a + w["weight"])
    return x.select("topic_id", "name", F.col("n_words").cast("long").alias("n_words"), words.alias("words"), q6(mass).alias("mass"))


@query(f"""with {THETA_SQL}, x as (select *, cast(split_part(topic_id, '_', 2) as int) // 10 as slice from theta where topic_weight >= 0.0001),
 r as (select *, row_number() over (partition by document_id, slice order by topic_weight desc, topic_id) as rank from x)
 select document_id, topic_id, cast(slice as bigint) as slice, rank, {s6('topic_weight')} from r where rank <= 5""")
def theta_topk(spark, d):
    x = tp.theta_topk(views.theta(spark, d), 20, 2).select("document_id", "topic_id", "slice", F.col("rank").cast("long").alias("rank"), "topic_weight")
    return rounded(x, "topic_weight")


@query(f"""with {PHI_SQL}, r as ({RANKED.format(0)}), s as (select topic_id, list(word) as w from r where rank <= 100 group by 1),
 p as (select len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) as j from s a join s b on a.topic_id < b.topic_id)
 select count(*) as pairs, {s6('avg(j)', 'mean_jaccard')} from p""")
def topic_word_jaccard(spark, d):
    return rounded(tp.mean_word_jaccard(views.phi(spark, d)), "mean_jaccard")


#: The sequential choice as a recursion over the topics, with the pairs sent so far as a list.
COMBOS = f"""{THETA_SQL}, {PHI_SQL}, r as ({RANKED.format(0)}), s as (select topic_id, list(word) as w from r where rank <= 100 group by 1),
 j as (select a.topic_id as t1, b.topic_id as t2, round(len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))), 12) as j from s a join s b on a.topic_id < b.topic_id),
 m as (select round(avg(j), 12) as m from j), x as (select * from theta where topic_weight >= 0.1),
 bound as (select count(distinct document_id) / (select count(distinct topic_id) from phi) / 2 as bound from x),
 p as (select a.topic_id as t1, b.topic_id as t2, count(*) as n from x a join x b using (document_id) where a.topic_id < b.topic_id group by 1, 2),
 kept as (select t1, t2, n from p where not exists (select 1 from j, m where j.t1 = p.t1 and j.t2 = p.t2 and j.j > m.m)),
 sides as (select t1 as t, t2 as o, t1 || ' ' || t2 as pair, n from kept union all select t2, t1, t1 || ' ' || t2, n from kept),
 turns as (select t, row_number() over (order by t) as i from (select distinct t from sides)),
 greedy(i, sent) as (select 0::bigint, []::varchar[] union all select g.i + 1, list_concat(g.sent, coalesce((select list(pair) from
 (select pair, n, row_number() over (order by n desc, o) as rank from sides join turns using (t) where turns.i = g.i + 1 and not list_contains(g.sent, pair))
 where rank <= 5 or n > (select bound from bound)), []::varchar[])) from greedy g where g.i < (select count(*) from turns)),
 chosen as (select unnest(sent) as pair from greedy where i = (select count(*) from turns)),
 combos as (select t1 as topic_1, t2 as topic_2, n as common_docs from kept join chosen on pair = t1 || ' ' || t2)"""


@query(f"with recursive {COMBOS} select topic_1, topic_2, common_docs from combos")
def topic_combos(spark, d):
    return tp.combos(views.theta(spark, d), views.phi(spark, d))


@query(f"with recursive {COMBOS} select topic_1, topic_2, a.document_id from combos join x a on a.topic_id = topic_1 join x b on b.topic_id = topic_2 and a.document_id = b.document_id")
def topic_combo_documents(spark, d):
    theta = views.theta(spark, d)
    listed = tp.stored_topics(theta)
    return tp.combo_documents(theta, tp.combos(theta, views.phi(spark, d), listed=listed), listed=listed)


@query(f"""with {PHI_SQL}, k as (select *, weight / sum(weight) over (partition by word) as p from phi)
 select topic_id, count(*) as kernel_size, {s6('sum(weight)', 'purity')}, {s6('avg(p)', 'contrast')} from k where p > 0.3 group by 1""")
def topic_kernel(spark, d):
    return rounded(tp.kernel(views.phi(spark, d)), "purity", "contrast")


@query(f"""with {PHI_SQL}, r as (select topic_id, word from ({RANKED.format(0)}) where rank <= 11), h as (select distinct doc_id, word from doc_words where word in (select word from r)),
 df as (select word, count(*) as df from h group by 1), j as (select a.word as w1, b.word as w2, count(*) as c from h a join h b using (doc_id) where a.word < b.word group by 1, 2),
 n as (select count(*) as n from documents), p as (select a.topic_id, case when c is null then -1.0 when c = n then 0.0 else ln(c * n / (d1.df * d2.df)) / -ln(c / n) end as v
 from r a join r b on a.topic_id = b.topic_id and a.word < b.word join df d1 on d1.word = a.word join df d2 on d2.word = b.word
 left join j on w1 = a.word and w2 = b.word cross join n) select topic_id, count(*) as pairs, {s6('avg(v)', 'coherence')} from p group by 1""")
def topic_coherence(spark, d):
    n = docs(spark, d).agg(F.count("*").alias("n_docs"))
    counted = stored(views.doc_words(spark, d), "words")
    return rounded(tp.coherence(counted, views.phi(spark, d, counted), n), "coherence")


@query(f"""with {PHI_SQL}, r as ({RANKED.format(0)}) select count(distinct word) as distinct_words, {s6('count(distinct word) / (25 * count(distinct topic_id))', 'diversity')} from r where rank <= 25""")
def topic_diversity(spark, d):
    return rounded(tp.diversity(views.phi(spark, d)), "diversity")


@query(f"""with {PHI_SQL}, n as (select count(distinct topic_id) as n from phi), df as (select word, count(*) as df from phi group by 1),
 w as (select topic_id, word, tf, tf * (ln((1 + n) / (1 + df)) + 1) as w from phi join df using (word) cross join n),
 u as (select *, w / sqrt(sum(w * w) over (partition by topic_id)) as unit from w)
 select topic_id, word, tf, {s6('unit')}, {s6('unit / max(unit) over (partition by topic_id)', 'relative')} from u""")
def topic_tfidf(spark, d):
    return rounded(tp.tfidf(views.phi(spark, d).select("topic_id", "word", "tf")), "unit", "relative")


# Criteria -------------------------------------------------------------------------------------------------------------


def _eval_sql(mark: str = "mark", scale: str = "value") -> str:
    """``mark`` of each topic's mean ``scale``, 0 without one."""
    return (
        f"{THETA_SQL}, {EVAL_SQL}, m as (select topic_id, avg({scale}) as given from topic_eval group by 1), z as (select document_id, topic_id, topic_weight, coalesce(given, 0) as mark "
        f"from theta left join m using (topic_id) where topic_weight >= 0.001), x as (select document_id, topic_id, topic_weight, {mark} as mark, "
        "row_number() over (partition by document_id order by topic_weight desc, topic_id) as rank from z)"
    )


VALUE = "select document_id, sum(topic_weight * mark) / sum(topic_weight) as value, count(*) as n_topics from x where rank <= 50 group by 1"
UNIT = "((value + 1) / 2)"  # the experts' values on a scale from 0


def _marks(spark, d, unit=False):
    e = views.topic_eval(spark, d)
    return cr.marks(e.withColumn("value", (F.col("value") + 1) / 2) if unit else e)


@query(f"with {_eval_sql()}, v as ({VALUE}) select document_id, {s6('value')}, n_topics from v")
def criterion_eval(spark, d):
    return rounded(cr.evaluate(views.theta(spark, d), _marks(spark, d)), "value")


@query(f"with {_eval_sql('-mark')}, v as ({VALUE}) select document_id, {s6('value')}, n_topics from v")
def criterion_eval_negative(spark, d):
    return rounded(cr.evaluate(views.theta(spark, d), _marks(spark, d), negative=True), "value")


@query(f"with {_eval_sql('1 - mark', UNIT)}, v as ({VALUE}) select document_id, {s6('value')}, n_topics from v")
def criterion_eval_negative_unit(spark, d):
    """On a scale from 0: what is left of 1, so 1 for topics without a mark."""
    return rounded(cr.evaluate(views.theta(spark, d), _marks(spark, d, unit=True), low=0.0, negative=True), "value")


def _extremes_sql(over: str, under: str, scale: str = "value") -> str:
    return f"""with {_eval_sql('mark', scale)}, p as (select document_id, topic_id, round(topic_weight * mark, 12) as part from x where rank <= 50),
 r as (select *, row_number() over (partition by document_id order by part desc, topic_id) as t, row_number() over (partition by document_id order by part, topic_id) as b from p)
 select document_id, coalesce(string_agg(topic_id, ',' order by t) filter (part > {over} and t <= 3), '') as topic_ids_top,
 coalesce(string_agg(topic_id, ',' order by b) filter (part < {under} and b <= 3), '') as topic_ids_bottom from r group by 1"""


def _listed(x):
    return x.select("document_id", *(F.array_join(c, ",").alias(c) for c in ("topic_ids_top", "topic_ids_bottom")))


@query(_extremes_sql("0.1", "-0.1"))
def criterion_top_bottom(spark, d):
    return _listed(cr.extremes(views.theta(spark, d), _marks(spark, d)))


@query(_extremes_sql("0.001", "-1e9", UNIT))
def criterion_top_unit(spark, d):
    """On a scale from 0 there is no bottom."""
    return _listed(cr.extremes(views.theta(spark, d), _marks(spark, d, unit=True), low=0.0))


@query(f"""with {THETA_SQL}, v as (select topic_id, coalesce(avg(nullif(topic_weight, 0)) filter (document_id % 10 = 0), 0) as v from theta group by 1),
 e as (select min(v) as lo, max(v) as hi from v) select topic_id, {s6('(v - lo) / case when hi = lo then 1 else hi - lo end', 'mark')} from v, e""")
def criterion_by_docs(spark, d):
    theta = views.theta(spark, d)
    examples = theta.select("document_id").where("document_id % 10 = 0").distinct()
    return rounded(cr.by_documents(theta, examples), "mark")


@query(f"""with {PHI_SQL}, {EVAL_SQL}, m as (select topic_id, avg(value) as mark from topic_eval group by 1),
 x as (select topic_id, word, weight * mark as raw, cast(sign(mark) as int) as sign from phi join m using (topic_id) where mark <> 0),
 y as (select *, min(raw) over (partition by sign) as lo, max(raw) over (partition by sign) as hi from x)
 select sign, topic_id, word, {s6('(raw - lo) / case when hi = lo then 1 else hi - lo end * (1 - 1e-6) + case when sign > 0 then 1e-6 else -1 end', 'score')} from y""")
def eval_dict(spark, d):
    return rounded(cr.word_scores(views.phi(spark, d), _marks(spark, d)), "score")


TOPICS = "topics as (select 'topic_' || i as topic_id from range(20) t(i))"
P1 = f"""{EVAL_SQL}, {TOPICS}, v as (select topic_id, coalesce(s, 0) as v from topics left join (select topic_id, sum(value) / (count(*) + 1) as s from topic_eval group by 1) using (topic_id)),
 p1 as (select topic_id, (v - (select min(v) from v)) / (select case when max(v) = min(v) then 1 else max(v) - min(v) end from v) as p from v)"""
ODDS = "(({p} - 0.5) * {w} + 0.5 + pow(2, -20)) / (1 - (({p} - 0.5) * {w} + 0.5 + pow(2, -20)))"
REST = "pow((0.5 + pow(2, -20)) / (0.5 - pow(2, -20)), {n} - count(*))"


def topics(spark):
    return spark.range(20).select(F.concat(F.lit("topic_"), F.col("id")).alias("topic_id"))


@query(f"with {P1} select topic_id, {s6('p')} from p1")
def mma_p1(spark, d):
    return rounded(cr.first_matrix(topics(spark), views.topic_eval(spark, d)), "p")


@query(f"""with {THETA_SQL}, {P1}, o as (select document_id, product({ODDS.format(p='p', w='topic_weight')}) * {REST.format(n=20)} as o from theta join p1 using (topic_id) group by 1)
 select document_id, {s6('o / (1 + o)', 'score')} from o""")
def mma_scores(spark, d):
    return rounded(cr.document_scores(views.theta(spark, d), cr.first_matrix(topics(spark), views.topic_eval(spark, d)), 20), "score")


P3 = "p3 as (select c as criterion_id, k as class_id, ((c * 3 + k * 5) % 7 + 1) / 8.0::double as weight from range(2) a(c), range(3) b(k))"
P1_BOTH = f"""{P1}, p1b as (select topic_id, 0::bigint as criterion_id, p from p1 union all select topic_id, 1::bigint, 1 - p from p1), {P3},
 p4 as (select topic_id, class_id, o / (1 + o) as p from (select topic_id, class_id, product({ODDS.format(p='weight', w='p')}) * {REST.format(n=2)} as o
 from p1b join p3 using (criterion_id) group by 1, 2))"""


@query(f"""with {THETA_SQL}, {P1_BOTH}, o as (select document_id, class_id, product({ODDS.format(p='topic_weight', w='p')}) * {REST.format(n=20)} as o
 from theta join p4 using (topic_id) group by 1, 2) select document_id, class_id, {s6('o / (1 + o)', 'score')} from o""")
def mma_classes(spark, d):
    p1 = cr.first_matrix(topics(spark), views.topic_eval(spark, d))
    both = p1.select("topic_id", F.lit(0).cast("long").alias("criterion_id"), "p").union(p1.select("topic_id", F.lit(1).cast("long"), 1 - F.col("p")))
    c, k = spark.range(2).toDF("criterion_id"), spark.range(3).toDF("class_id")
    p3 = c.crossJoin(k).withColumn("weight", ((F.col("criterion_id") * 3 + F.col("class_id") * 5) % 7 + 1) / 8.0)
    return rounded(cr.document_classes(views.theta(spark, d), cr.classes(both, p3, 2), 20), "score")


@query(f"""with {_eval_sql()}, v as ({VALUE}) select {s6('quantile_cont(value, 0.1)', 'low_at')}, {s6('quantile_cont(value, 0.9)', 'high_at')} from v""")
def percentile_threshold(spark, d):
    v = cr.evaluate(views.theta(spark, d), _marks(spark, d))
    return rounded(cr.thresholds(stored(v, "values"), 0.1, 0.9), "low_at", "high_at")


LIMITS = f"""e as ({VALUE}), limits as (select (select quantile_cont(value, {{0}}) from e) as value_at, (select quantile_cont(topic_weight, 0.6) from theta) as weight_at),
 v as (select document_id, coalesce(sum(topic_weight * given), 0) as value, count(*) filter (round(topic_weight, 9) >= round(weight_at, 9)) as relevant
 from theta left join m using (topic_id), limits group by 1)"""


def _report(spark, d, at, kind):
    theta, m = stored(views.theta(spark, d), "theta"), _marks(spark, d)
    value_at = quantiles(stored(cr.evaluate(theta, m), "values"), "value", [at])
    limits = spark.createDataFrame([(*value_at, *quantiles(theta, "topic_weight", [0.6]))], "value_at double, weight_at double")
    return rounded(cr.report(theta, m, limits, kind, 2), "value")


@query(f"with {_eval_sql()}, {LIMITS.format(0.9)} select document_id, {s6('value')} from v, limits where value > value_at and relevant >= 2")
def subscription_report(spark, d):
    return _report(spark, d, 0.9, 1)


@query(f"with {_eval_sql()}, {LIMITS.format(0.2)} select document_id, {s6('value')} from v, limits where value < value_at and relevant >= 2")
def subscription_report_under(spark, d):
    return _report(spark, d, 0.2, -1)


@query(f"with {_eval_sql()}, {LIMITS.format(0.5)} select document_id, {s6('value')} from v where relevant >= 2")
def subscription_report_all(spark, d):
    return _report(spark, d, 0.5, 0)
