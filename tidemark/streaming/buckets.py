"""A keyed table in hash buckets that batches of a stream change.

``rows/batch=n/bucket=b`` holds bucket b as batch n left it; ``commits/batch=n`` names the version of every bucket after
batch n and is written last. A batch reads and rewrites only the buckets that its keys fall in. One that died half way shows
nothing and replaces its leavings when it is run again; one that is run again after its commit changes nothing. One writer
at a time; the numbers of batches must grow, as those of one stream's ``foreachBatch`` do: an older one raises an error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.scratch import delete

#: Buckets of a table: the rows of the driver's map of versions.
BUCKETS = 256

#: Merge of the touched buckets' rows with a batch: (rows, changes) -> rows, of the table's columns.
Merge = Callable[[DataFrame, DataFrame], DataFrame]


def bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _numbers(spark: SparkSession, path: str, pattern: str) -> set[int]:
    """n of the folders ``name=n`` under a path of Hadoop's, or of their marked files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder) or []
    names = (str(f.getPath()).removesuffix("/_SUCCESS") for f in found)
    return {int(n.rpartition("=")[2]) for n in names}


def batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed batches."""
    return sorted(_numbers(spark, path, "commits/batch=*/_SUCCESS"))


def versions(spark: SparkSession, path: str) -> dict[int, int | None]:
    """Bucket -> batch that wrote it last, null where that left no rows; one entry for each bucket ever written."""
    done = batches(spark, path)
    if not done:
        return {}
    return dict(map(tuple, spark.read.schema("bucket int, version long").parquet(f"{path}/commits/batch={done[-1]}").collect()))


def _rows(spark: SparkSession, path: str, schema: T.StructType, of: dict[int, int | None]) -> DataFrame:
    paths = [f"{path}/rows/batch={n}/bucket={b}" for b, n in sorted(of.items()) if n is not None]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The table's rows as the last committed batch left them; none where there is no table."""
    return _rows(spark, path, _struct(schema), versions(spark, path))


def write(changes: DataFrame, number: int, path: str, schema: str | T.StructType, keys: list[str], merge: Merge, buckets: int = BUCKETS) -> None:
    """Apply one batch. ``keys`` and ``buckets`` stay the same for a table's life. Rows of one bucket may lie in several
    files, so that those of a hot key don't wait for one task. An empty batch commits the versions as they are."""
    spark = changes.sparkSession
    done = batches(spark, path)
    if done and number < done[-1]:
        raise ValueError(f"batch {number} comes after batch {done[-1]} of {path}; a new stream needs a new table or greater numbers")
    if number in done:
        return
    known = versions(spark, path)
    schema = _struct(schema)
    changes = changes.withColumns({k: F.col(k).cast(schema[k].dataType) for k in keys})  # a long's hash is not an int's
    changes = changes.withColumn("__bucket", bucket(keys, buckets)).persist()
    try:
        touched = {r["__bucket"] for r in changes.select("__bucket").distinct().collect()}
        if touched:
            old = _rows(spark, path, schema, {b: known.get(b) for b in touched})
            out = merge(old, changes.drop("__bucket")).select(*schema.fieldNames()).withColumn("bucket", bucket(keys, buckets))
            out.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows/batch={number}")
            filled = _numbers(spark, path, f"rows/batch={number}/bucket=*")
            known |= {b: number if b in filled else None for b in touched}
        commit = spark.createDataFrame(sorted(known.items()), "bucket int, version long")
        commit.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/batch={number}")
    finally:
        changes.unpersist()


def each(path: str, schema: str | T.StructType, keys: list[str], merge: Merge, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """``write`` as a batch function of ``foreachBatch``."""
    return lambda batch, number: write(batch, number, path, schema, keys, merge, buckets)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the versions that the last commit does not name, and all earlier commits; the number of deleted versions.
    Readers that began before the last commit may miss their files."""
    done = batches(spark, path)
    if not done:
        return 0
    kept = {(n, b) for b, n in versions(spark, path).items()}
    gone = [(n, b) for n in sorted(_numbers(spark, path, "rows/batch=*")) if n <= done[-1] for b in _numbers(spark, path, f"rows/batch={n}/bucket=*") if (n, b) not in kept]
    for n in done[:-1]:
        delete(spark, f"{path}/commits/batch={n}")
    for n, b in gone:
        delete(spark, f"{path}/rows/batch={n}/bucket={b}")
    return len(gone)


def absent_only(keys: list[str]) -> Merge:
    """Rows whose keys (null equals null) the table lacks, one for each; the table's own stay."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        fresh = new.dropDuplicates(keys)
        known = old.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
        same = [fresh[k].eqNullSafe(known[f"__{k}"]) for k in keys]
        return old.unionByName(fresh.join(known, same, "left_anti"), allowMissingColumns=True)

    return merge


def replacing(keys: list[str], order: Column) -> Merge:
    """The whole row with the greatest ``order`` (nulls least) of each key (null equals null), the table's or a change."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.unionByName(new, allowMissingColumns=True)
        return both.groupBy(*keys).agg(F.max_by(F.struct(*both.columns), F.struct(order)).alias("r")).select("r.*")

    return merge


def updating(key: str, columns: list[str], order: Column) -> Merge:
    """Partial update of all rows of a key: the changes' last known values by ``order``, the greater of equals, replace the
    rows'; keys that the table lacks change nothing, null keys neither."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        by = lambda c: F.when(F.col(c).isNotNull(), F.struct(order, c))
        last = new.where(F.col(key).isNotNull()).groupBy(key).agg(*(F.max_by(c, by(c)).alias(f"__{c}") for c in columns))
        out = old.join(last, key, "left")
        return out.select(*(F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in old.columns))

    return merge
