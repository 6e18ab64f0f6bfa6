"""Tables in the folder that driver and executors share, to end lineage and compute nothing twice."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of files that a task of ``small_splits`` reads at most.
SPLIT_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a temporary folder in local mode, as in tests, and an error on a cluster,
    whose executors don't share one."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir")
    if not base:
        jvm_dir = sc._jsc.sc().getCheckpointDir()
        base = jvm_dir.get() if jvm_dir.isDefined() else None
    if not base:
        if sc.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` (with the writer's ``options``) and read it back; a lost executor costs at most the step in hand.
    ``discard`` deletes the table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for t in tables:
        delete(t.sparkSession, t.scratch)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def small_splits(spark: SparkSession, most: int = SPLIT_BYTES) -> Iterator[None]:
    """What is run inside reads files in splits of ``most`` bytes or less: a task that shuffles its rows into many parts holds
    all rows of a split."""
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > most:
        spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def free(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are stored; it does so as their handles are collected.
    Only a hint that lowers the use of disk early; no result or limit rests on it."""
    for _ in range(2):  # handles of handles
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
