"""Spark session setup and the shared scratch location.

Session settings the warehouse depends on:

* ``spark.sql.session.timeZone=UTC`` so ``timestamptz`` values and
  date casts do not depend on the machine.
* ANSI mode (Spark's default) so a bad cast fails like Postgres does.
* AQE on: runtime re-planning decides broadcast vs. shuffle from the real
  size of each join side, coalesces small shuffle partitions and splits
  skewed ones.

Intermediate data (stream checkpoints, merge versions written by a query)
always goes below ``spark.checkpoint.dir`` so it lands in the cluster's
shared folder. A directory of our own is only set when the session has none,
which is the case in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    # Size estimates of file scans start from compressed bytes; columnar
    # Parquet expands several-fold in memory. Scaling the estimate keeps a
    # fact table that merely compresses well from being planned as a
    # broadcast side; AQE still broadcasts small sides from runtime sizes.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "starmart",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; create a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="starmart-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint dir."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/starmart-scratch/{name}-{uuid.uuid4().hex[:12]}"


#: Has Spark delete a query's shuffle files when it ends, not when the driver
#: happens to collect garbage.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def freed_shuffles(spark: SparkSession):
    """Queries that run in here leave no shuffle files behind."""
    return _setting(spark, _FREE_SHUFFLES, "true")


def arrow_batches(spark: SparkSession, rows: int):
    """Python tasks of queries that run in here get so many rows at a time, at
    most: of rows with long arrays, Spark's default fills 64 MB a batch."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def discard_path(spark: SparkSession, path: str) -> None:
    """Delete scratch files that nothing reads any more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so the path can be used with os APIs (tests)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
