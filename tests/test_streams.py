"""Bucketed upserts, sticky feeds and passed-on counters: batches, replays and deaths against plain re-statements."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import buckets, feeds, windows

ROW = "k int, v string"


def rows(spark, path, schema=ROW):
    return sorted(map(tuple, buckets.read(spark, path, schema).collect()), key=repr)


def test_stream_appends_once(spark, tmp_path):
    src, out, ck = (f"file://{tmp_path}/{n}" for n in ("src", "out", "ck"))
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n")], ROW).write.parquet(src)
    run = lambda: feeds.run_once(feeds.read_files(spark, src, ROW), feeds.append_absent(out, "k", ROW, 4), ck)
    run()
    run()
    spark.createDataFrame([(2, "z"), (3, "c"), (None, "m")], ROW).write.mode("append").parquet(src)
    run()
    assert rows(spark, out) == sorted([(1, "a"), (2, "b"), (3, "c"), (None, "n")], key=repr)


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    each = feeds.append_absent(path, "k", ROW, 16)
    each(spark.createDataFrame([(i, "a") for i in range(200)], ROW), 0)
    before = buckets.versions(spark, path)
    each(spark.createDataFrame([(7, "b"), (1000, "b")], ROW), 1)
    after = buckets.versions(spark, path)
    assert len(before) == 16 and 1 <= sum(after[b] != before[b] for b in after) <= 2
    assert len(rows(spark, path)) == 201 and (7, "a") in rows(spark, path)


def test_dead_batch_shows_nothing_and_replays(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    merge = buckets.replacing(["k"], F.col("v"))
    put = lambda n, got, m=merge: buckets.write(spark.createDataFrame(got, ROW), n, path, ROW, ["k"], m, 3)
    put(0, [(i, "a") for i in range(9)])
    old = rows(spark, path)

    # a batch that wrote its rows and died before its commit
    dead = spark.createDataFrame([(i, "dead", i % 3) for i in range(9)], "k int, v string, bucket int")
    dead.write.partitionBy("bucket").parquet(f"{path}/rows/batch=1")
    assert rows(spark, path) == old
    put(1, [(3, "b"), (None, "x"), (None, "y")])
    want = sorted([(i, "b" if i == 3 else "a") for i in range(9)] + [(None, "y")], key=repr)
    assert rows(spark, path) == want
    put(1, [(4, "never")])  # its commit is there, so a replay does nothing
    assert rows(spark, path) == want
    with pytest.raises(ValueError, match="comes after"):
        put(0, [(4, "never")])
    put(5, [])
    assert rows(spark, path) == want
    assert buckets.vacuum(spark, path) > 0 and buckets.vacuum(spark, path) == 0
    assert rows(spark, path) == want and buckets.batches(spark, path) == [5]
    put(6, [(i, "gone") for i in range(9)], lambda o, n: o.where("false"))
    put(7, [(1, "again")])
    assert (1, "again") in rows(spark, path) and len([r for r in rows(spark, path) if r[0] is not None]) == 1


def test_empty_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert rows(spark, path) == [] and buckets.vacuum(spark, path) == 0
    buckets.write(spark.createDataFrame([(1, "a")], ROW), 0, path, ROW, ["k"], buckets.updating("k", ["v"], F.col("v")), 4)
    assert rows(spark, path) == [] and buckets.batches(spark, path) == [0]


def machine(messages, last):
    """The loop over one feed, message by message."""
    update, stopped, out = False, False, {}
    for i, ts in messages:
        update = update or (last is not None and ts is not None and ts < last)
        stopped = stopped or (last is not None and ts is not None and ts < last - timedelta(days=3))
        out[i] = "drop" if stopped else "update" if update else "insert"
    return out


def feed_case(seed):
    rng = random.Random(seed)
    now = datetime(2024, 3, 1)
    lasts = {"a": now, "b": now - timedelta(days=1), "c": None, "hot": now - timedelta(days=2)}
    log = []
    for at in range(400):
        feed = rng.choice(["a", "b", "c", "d", "hot", "hot", None])
        days = rng.choice([0.5, 0.2, -0.5, -1.0, -1.5]) if rng.random() < 0.97 else -6.0
        log.append((at, feed, None if rng.random() < 0.05 else now + timedelta(days=days)))
    want = {}
    for feed in {f for _, f, _ in log}:
        want |= machine([(at, ts) for at, f, ts in log if f == feed], lasts.get(feed))
    return log, lasts, want


MESSAGE = "at long, feed string, ts timestamp"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sticky_batch(spark, seed):
    log, lasts, want = feed_case(seed)
    df = spark.createDataFrame(log, MESSAGE).orderBy(F.rand(seed)).withColumn("last", F.lit("clash"))
    out, places = windows.sticky(df, spark.createDataFrame(list(lasts.items()), "feed string, last timestamp"), "feed", "at", "ts")
    assert {r["at"]: r["action"] for r in out.collect()} == want and out.columns == [*df.columns, "action"]
    assert len({*want.values()}) == 3 and places.count() == len({f for _, f, _ in log})


def test_sticky_stream_survives_restart(spark, tmp_path):
    """Batches in order of place, shuffled inside; the sink fails once in the middle, and the stream starts again."""
    log, lasts, want = feed_case(5)
    src, out, state, ck = (f"file://{tmp_path}/{n}" for n in ("src", "out", "state", "ck"))
    last = spark.createDataFrame(list(lasts.items()), "feed string, last timestamp")
    deaths = []

    def sink(df, number):
        df.write.mode("overwrite").parquet(f"{out}/batch={number}")
        if number == 2 and not deaths:
            deaths.append(number)
            raise OSError("killed")

    each = feeds.sticky_feeds(state, last, "feed", "at", "ts", sink, n=4)
    for i in range(0, 400, 100):
        part = log[i : i + 100]
        random.Random(i).shuffle(part)
        spark.createDataFrame(part, MESSAGE).coalesce(1).write.mode("append").parquet(src)
        run = lambda: feeds.run_once(feeds.read_files(spark, src, MESSAGE), each, ck)
        if i == 200:
            with pytest.raises(Exception, match="killed"):
                run()
        run()
    assert deaths and {r["at"]: r["action"] for r in spark.read.parquet(out).collect()} == want


def test_activity_two_hops(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    schema = "document_id string, topic string, num_views long, num_comments long"
    theta = [(f"e{i}", f"t{j}", 0, None) for i in range(6) for j in range(2)]
    buckets.write(spark.createDataFrame(theta, schema), -1, f"{path}/theta", schema, ["document_id"], lambda old, new: new, 4)
    links = spark.createDataFrame([(1, "e1"), (1, "e2"), (1, "e2"), (2, "e3"), (3, "missing"), (4, None), (5, "e5")], "doc_id int, document_id string")
    t0 = datetime(2024, 1, 1)
    batch = lambda *r: spark.createDataFrame([(d, t0 + timedelta(seconds=s) if s is not None else None, v, c) for d, s, v, c in r], "doc_id int, parsed timestamp, num_views long, num_comments long")
    apply = lambda n, b: feeds.activity(path, links, schema, ["num_views", "num_comments"], n=4)(b, n)
    got = lambda: {(r["document_id"], r["topic"]): (r["num_views"], r["num_comments"]) for r in buckets.read(spark, f"{path}/theta", schema).collect()}
    stamps = lambda: {r["doc_id"]: r["updated"] for r in buckets.read(spark, f"{path}/updated", "doc_id long, updated timestamp").collect()}

    apply(0, batch((1, 0, 5, None), (1, 10, None, 3), (2, 0, None, None), (3, 0, 9, 9), (4, 0, 8, 8), (None, 0, 7, 7), (5, None, 6, 6)))
    want = {(f"e{i}", f"t{j}"): (5, 3) if i in (1, 2) else (0, None) for i in range(6) for j in range(2)}
    assert got() == want and stamps() == {1: t0 + timedelta(seconds=10), 3: t0, 4: t0}
    apply(1, batch((1, 60, 6, 6), (2, 0, 1, None)))  # document 1 was passed on less than a minute ago
    want |= {("e3", f"t{j}"): (1, None) for j in range(2)}
    assert got() == want and stamps()[2] == t0
    apply(2, batch((1, 70, 9, None)))
    want |= {(e, f"t{j}"): (9, 3) for e in ("e1", "e2") for j in range(2)}
    assert got() == want and stamps()[1] == t0 + timedelta(seconds=70)
    apply(2, batch((1, 700, 1, 1)))  # a replay
    assert got() == want


def test_activity_dies_between_tables(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/a"
    schema = "document_id string, num_views long"
    buckets.write(spark.createDataFrame([("x", 0)], schema), -1, f"{path}/theta", schema, ["document_id"], lambda old, new: new, 2)
    links = spark.createDataFrame([(1, "x")], "doc_id long, document_id string")
    batch = spark.createDataFrame([(1, datetime(2024, 1, 1), 5)], "doc_id long, parsed timestamp, num_views long")
    each = feeds.activity(path, links, schema, ["num_views"], n=2)
    real = buckets.write

    def dying(changes, number, at, *rest):
        if at.endswith("updated"):
            raise OSError("killed")
        real(changes, number, at, *rest)

    with monkeypatch.context() as m:
        m.setattr(buckets, "write", dying)
        with pytest.raises(OSError, match="killed"):
            each(batch, 0)
    each(batch, 0)
    assert rows(spark, f"{path}/theta", schema) == [("x", 5)]
    assert buckets.read(spark, f"{path}/updated", "doc_id long, updated timestamp").count() == 1
