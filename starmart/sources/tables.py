"""Scan of the driver's Parquet tables (I-10).

Reads are lazy: nothing is scanned until an action, and Catalyst pushes
column pruning and filters down into each Parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# Analysed scans, per Spark application and path. A DataFrame is an
# immutable lazy plan, so queries of one application can share the scan
# (file listing and footer schema are read once) — no data is cached.
_SCANS: dict[tuple[str, str], DataFrame] = {}


def app_id(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


class Tables:
    """Attribute access to ``<sf_dir>/<name>.parquet`` as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        key = (app_id(self.spark), path)
        df = _SCANS.get(key)
        if df is None:
            df = _SCANS[key] = self.spark.read.parquet(path)
        return df

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.read(name)
        raise AttributeError(name)

    def register_views(self, names=TABLES) -> None:
        for n in names:
            self.read(n).createOrReplaceTempView(n)

    @cached_property
    def names(self) -> tuple[str, ...]:
        return TABLES
