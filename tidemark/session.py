"""Session settings, and the package's way to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application, so that they can import it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark_src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f"{top.name}/{f.relative_to(top)}")
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
