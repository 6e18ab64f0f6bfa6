"""Feeds as streams: read new files, upsert what is not too late, pass counters on, alert."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.relational import is_dirty
from tidemark.streaming import buckets
from tidemark.streaming.windows import HORIZON, sticky

Batch = Callable[[DataFrame, int], None]


def read_files(spark: SparkSession, folder: str, schema: str, files_at_once: int = 1000) -> DataFrame:
    """New Parquet files of a folder; the checkpoint is the cursor."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def run_once(stream: DataFrame, each: Batch, checkpoint: str) -> None:
    """Hand all that is new to ``each`` in batches, then stop."""
    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def append_absent(path: str, key: str, schema: str | T.StructType, n: int = buckets.BUCKETS) -> Batch:
    """A batch function that inserts rows whose key the bucketed table at ``path`` lacks; a batch reads only the buckets of
    its own keys. Read the table by ``buckets.read``."""
    return buckets.each(path, schema, [key], buckets.absent_only([key]), n)


def activity(path: str, links: DataFrame, theta_schema: str | T.StructType, counters: list[str], stamp: Column | None = None, n: int = buckets.BUCKETS) -> Batch:
    """A batch function that passes counters of documents (doc_id, parsed, the counters) on over two hops: document ->
    stored documents by ``links`` (doc_id, document_id; several of each are well) -> all rows of a topic table at
    ``path``/theta, of columns ``theta_schema`` with document_id and the counters, bucketed by document_id.

    A document is passed on if a counter is known and it was parsed a minute or more after it was last passed on, or never
    was. ``path``/updated keeps (doc_id, updated); ``stamp``, the time of parsing by default, is what it is set to, after
    the topic table: a batch that dies between both is passed on again, with the same result. Nulls: a null counter leaves
    the old value; rows with null doc_id or parsed are passed over. Of several rows of a document in a batch each counter's
    last known value by ``parsed`` counts, the greater of equals.
    """
    stamped = "doc_id long, updated timestamp"

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.where(F.col("doc_id").isNotNull() & F.col("parsed").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "parsed", *counters)
        done = buckets.read(spark, f"{path}/updated", stamped)
        known = rows.join(done, "doc_id", "left")
        dirty = known.where(is_dirty(F.col("parsed"), F.col("updated"), *map(F.col, counters))).select("doc_id", "parsed", *counters).persist()
        try:
            changes = dirty.join(links.select(F.col("doc_id").cast("long").alias("doc_id"), "document_id").distinct(), "doc_id").drop("doc_id")
            buckets.write(changes, number, f"{path}/theta", theta_schema, ["document_id"], buckets.updating("document_id", counters, F.col("parsed")), n)
            times = dirty.groupBy("doc_id").agg(F.max(F.col("parsed") if stamp is None else stamp).cast("timestamp").alias("updated"))
            buckets.write(times, number, f"{path}/updated", stamped, ["doc_id"], buckets.replacing(["doc_id"], F.col("updated")), n)
        finally:
            dirty.unpersist()

    return run


def sticky_feeds(path: str, last: DataFrame, feed: str, at: str, ts: str, sink: Batch, horizon: str = HORIZON, n: int = buckets.BUCKETS) -> Batch:
    """A batch function that gives each message of a feed its action, by ``windows.sticky``, over batches: once a message is
    older than the feed's ``last``, later ones are updates, and after one beyond the horizon the feed has stopped. The
    two places where that happened are all the state there is, in a bucketed table at ``path``; places (``at``, a long) of
    later batches are greater. ``sink`` gets (messages with action, number) and must bear being called again."""
    schema = f"{feed} string, old_at long, stop_at long"

    def earlier(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.unionByName(new).groupBy(feed).agg(F.min("old_at").alias("old_at"), F.min("stop_at").alias("stop_at"))

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn(feed, F.col(feed).cast("string"))
        known = last.select(F.col(feed).cast("string").alias(feed), "last")
        out, places = sticky(batch, known, feed, at, ts, horizon, buckets.read(spark, path, schema))
        sink(out, number)
        buckets.write(places, number, path, schema, [feed], earlier, n)

    return run
