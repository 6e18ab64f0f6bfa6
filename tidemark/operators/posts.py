"""Posts of social networks as rows of one schema, and which of them a run inserts, updates or leaves.

Each function takes a network's posts as its interface returns them, with the ``account_id`` (our own) they were read for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import hashtags, short_title

COUNTERS = ("num_views", "num_likes", "num_shares", "num_comments")


def _documents(df: DataFrame, source: str, text: Column, at: Column, url: Column, title: Column | None = None, tags: Column | None = None, **counters: Column) -> DataFrame:
    """account_id, source, title, text, datetime, url, the counters and hashtags; a network's missing counters are null."""
    head = F.concat(F.lit("Пост от "), F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(": "), short_title(text) if title is None else title)
    numbers = [counters.get(c, F.lit(None)).cast("long").alias(c) for c in COUNTERS]
    tags = F.array().cast("array<string>") if tags is None else tags
    return df.select(
        "account_id", F.lit(source).alias("source"), head.alias("title"), text.alias("text"), at.alias("datetime"), url.alias("url"), *numbers, tags.alias("hashtags")
    )


def _key(owner: Column, number: Column) -> Column:
    return F.concat(owner.cast("string"), F.lit("-"), number.cast("string"))


def wall(posts: DataFrame, owner: str = "account_id") -> DataFrame:
    """VK: id, date, text, and comments, reposts, likes with a count. ``owner`` is owner_id for posts found by a search."""
    n = {"num_comments": F.col("comments.count"), "num_shares": F.col("reposts.count"), "num_likes": F.col("likes.count")}
    return _documents(posts, "VK", F.col("text"), F.col("date"), _key(F.col(owner), F.col("id")), **n)


def channel(messages: DataFrame) -> DataFrame:
    """Telegram: id, date, text, views."""
    return _documents(messages, "Telegram", F.col("text"), F.col("date"), _key(F.col("account_id"), F.col("id")), num_views=F.col("views"))


def photos(media: DataFrame) -> DataFrame:
    """Instagram: date, caption, likes_count, comments_count, display_url. Hashtags come from the caption."""
    n = {"num_likes": F.col("likes_count"), "num_comments": F.col("comments_count")}
    return _documents(media, "Instagram", F.col("caption"), F.col("date"), F.col("display_url"), tags=F.coalesce(hashtags(F.col("caption")), F.array().cast("array<string>")), **n)


def videos(found: DataFrame) -> DataFrame:
    """YouTube: video_id, date, video_title, and the metadata's video_description, video_tags (split by ``|``) and counts."""
    n = {"num_comments": F.col("video_comment_count"), "num_likes": F.col("video_like_count"), "num_views": F.col("video_view_count")}
    tags = F.split("video_tags", r"\|")
    return _documents(found, "YouTube", F.col("video_description"), F.col("date"), _key(F.col("account_id"), F.col("video_id")), F.col("video_title"), tags, **n)


def planned(posts: DataFrame, target: DataFrame, last: DataFrame) -> DataFrame:
    """``posts`` with the ``action`` of a run: insert or update. ``target`` holds the stored urls, ``last`` (account_id,
    last) each account's latest stored time.

    Posts without text, and those over three days older than ``last``, are left out. A post since ``last`` is inserted
    unless its url is stored (then it is left as it is); an older one updates the counters of its stored row, and is
    inserted without one. Of posts with equal urls the latest counts; a post without a url is always new. A post without a
    time is inserted unless its url is stored.
    """
    x = posts.where("text <> ''").join(last, "account_id", "left")
    x = x.where(F.col("last").isNull() | F.col("datetime").isNull() | (F.col("datetime") >= F.col("last") - F.expr("INTERVAL 3 DAYS")))
    named = x.where("url is not null").groupBy("url").agg(F.max_by(F.struct(*x.columns), F.struct("datetime", "account_id", "title")).alias("r")).select("r.*")
    x = named.unionByName(x.where("url is null")).join(target.select("url", F.lit(True).alias("known")).distinct(), "url", "left")
    action = F.when(F.col("known").isNull(), "insert").when(F.col("datetime") < F.col("last"), "update")
    return x.withColumn("action", action).where("action is not null").select(*posts.columns, "action")
