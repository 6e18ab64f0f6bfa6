"""Topic dynamics: series over time, their statistics and up-periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def series(theta: DataFrame, least: float = 0.05, since: str = "2000-01-01", step: str = "day") -> DataFrame:
    """topic_id, day, weight, n, weight_share, n_share; empty steps inside a topic's span are 0.

    Shares are of all topics at that step; a step without any total keeps its weight and gets share 0 for counts.
    """
    kept = theta.where((F.col("topic_weight") >= least) & (F.col("datetime") >= F.lit(since).cast("timestamp_ntz")))
    per = kept.groupBy("topic_id", F.trunc(F.to_date("datetime"), step).alias("day") if step != "day" else F.to_date("datetime").alias("day"))
    per = per.agg(F.sum("topic_weight").alias("weight"), F.count("*").alias("n"))
    total = per.groupBy("day").agg(F.sum("weight").alias("total_weight"), F.sum("n").alias("total_n"))
    span = per.groupBy("topic_id").agg(F.min("day").alias("a"), F.max("day").alias("z"))
    days = span.select("topic_id", F.explode(F.expr(f"sequence(a, z, interval 1 {step})")).alias("day"))
    out = days.join(per, ["topic_id", "day"], "left").fillna(0, ["weight", "n"]).join(total, "day", "left")
    share = lambda x, t, other: F.when(F.coalesce(F.col(t), F.lit(0)) != 0, F.col(x) / F.col(t)).otherwise(other)
    return out.select(
        "topic_id", "day", "weight", "n", share("weight", "total_weight", F.col("weight")).alias("weight_share"), share("n", "total_n", F.lit(0.0)).alias("n_share")
    )


def smooth(s: DataFrame, half: int = 0, value: str = "weight_share") -> DataFrame:
    """Centred moving average over 2 * half + 1 steps; half 0 changes nothing."""
    w = Window.partitionBy("topic_id").orderBy("day").rowsBetween(-half, half)
    return s.withColumn(value, F.avg(value).over(w))


def stats(s: DataFrame, value: str = "weight_share") -> DataFrame:
    """Mean, geometric mean (0 if any step is 0), population deviation, deviation and median of absolute changes; topics
    of one step have no row."""
    step = F.abs(F.col(value) - F.lead(value).over(Window.partitionBy("topic_id").orderBy("day")))
    geometric = F.when(F.min(value) <= 0, F.lit(0.0)).otherwise(F.exp(F.avg(F.ln(F.when(F.col(value) > 0, F.col(value))))))
    out = s.withColumn("change", step).groupBy("topic_id").agg(
        F.count("*").alias("steps"), F.avg(value).alias("weight_mean"), geometric.alias("weight_geom_mean"), F.stddev_pop(value).alias("weight_std"),
        F.stddev_pop("change").alias("weight_change_std"), F.median("change").alias("weight_change_median"),
    )
    return out.where("steps >= 2")


def periods(s: DataFrame, value: str = "weight_share") -> DataFrame:
    """Each closed up-period: topic_id, period_start (place in the series), period_length, period_max.

    A period opens above the topic's geometric mean and closes below it; a step equal to it changes nothing; compared at
    12 decimals. Kept when its maximum is over the mean by more than half a deviation. An open end is left out.
    """
    w = Window.partitionBy("topic_id").orderBy("day")
    st = stats(s, value).select("topic_id", "weight_mean", "weight_geom_mean", "weight_std")
    x = s.join(st, "topic_id").withColumn("i", F.row_number().over(w) - 1)
    side = F.signum(F.round(F.col(value), 12) - F.round("weight_geom_mean", 12))
    x = x.withColumn("up", F.coalesce(F.last(F.when(side != 0, side), ignorenulls=True).over(w), F.lit(-1.0)) > 0)
    x = x.withColumn("run", F.sum(F.when(F.col("up") != F.lag("up", 1, False).over(w), 1).otherwise(0)).over(w))
    last = F.max("i").over(Window.partitionBy("topic_id"))
    runs = x.withColumn("last", last).where("up").groupBy("topic_id", "run").agg(
        F.min("i").alias("period_start"), F.count("*").alias("period_length"), F.max(value).alias("period_max"), F.max("i").alias("end"),
        F.first("last").alias("last"), F.first("weight_mean").alias("m"), F.first("weight_std").alias("s"),
    )
    return runs.where("end < last and period_max - m > 0.5 * s").select("topic_id", "period_start", "period_length", "period_max")


def period_stats(p: DataFrame) -> DataFrame:
    return p.groupBy("topic_id").agg(
        F.count("*").alias("period_num"), F.avg("period_length").alias("period_mean"), F.stddev_pop("period_length").alias("period_std"), F.avg("period_max").alias("period_maxes_mean")
    )


def model_stats(topic_stats: DataFrame, by_period: DataFrame) -> DataFrame:
    """Medians and deviations over topics; a topic without the figure doesn't count."""
    x = topic_stats.join(by_period, "topic_id", "left")
    both = lambda c, n: (F.median(c).alias(f"{n}_median"), F.stddev_pop(c).alias(f"{n}_std"))
    return x.agg(*both("period_mean", "period"), *both("period_maxes_mean", "period_maxes_mean"), *both("weight_std", "weight_std"))


def windows(start: str, end: str, volume: int, step: int) -> list[tuple[int, str, str]]:
    """Sliding windows of ``volume`` days every ``step`` days: int((end - start) / step) - 1 of them."""
    from datetime import date, timedelta

    a, z = date.fromisoformat(start), date.fromisoformat(end)
    return [(i, str(a + timedelta(i * step)), str(a + timedelta(i * step + volume))) for i in range((z - a).days // step - 1)]
