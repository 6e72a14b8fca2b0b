"""T-1: incremental merge as a stateful Structured Streaming job.

Landed page files are a file stream. The latest row of every key is a
streaming aggregate (``max_by``, partial before the shuffle) whose state lies in
the RocksDB state store, so state may outgrow an executor's memory and every
checkpoint uploads changes only. In update mode a micro-batch gives the keys
that it touched, and only these are written: the stored table is never read or
rewritten by the stream.

Each micro-batch's rows go to a folder named by the query and the batch. A batch
that is replayed after a crash replaces its own folder. Readers take the latest
row of each key over all folders, by the same order as the state, so the table is
right after any number of restarts, and with a new checkpoint as well.
``trigger(availableNow=True)`` turns the job into the daily batch: consume what
has landed, then stop. A page that isn't JSON fails the stream.

State holds one row per key ever seen; its partitions are those of the first run
(``spark.sql.shuffle.partitions``), so size them for the keys to come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.operators.scd2 import latest_per_key
from starmart.plans.versions import _FS
from starmart.sources.landing import normalize_names, page_schema, stringify

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def page_rows(pages: DataFrame) -> DataFrame:
    return normalize_names(stringify(pages.select(F.explode("data").alias("r")).select("r.*")))


class LatestTable:
    """The rows a stream wrote: one folder a micro-batch, the latest row of a
    key counts."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: list[str]):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, order

    def batches(self) -> list[str]:
        """``query=…/batch=…`` of every micro-batch that was written."""
        fs = _FS(self.spark, self.path)
        queries = [n for n in fs.list_names(fs.path) if n.startswith("query=")]
        return sorted(f"{q}/{b}" for q in queries for b in fs.list_names(fs.child(q)) if b.startswith("batch="))

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function. Batch ids count from 0 in each checkpoint,
        so they name a folder within their query only."""
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows.write.mode("overwrite").parquet(f"{self.path}/query={query}/batch={batch_id:010d}")

    def read(self) -> DataFrame | None:
        folders = self.batches()
        if not folders:
            return None
        rows = self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.path}/{f}" for f in folders])
        return latest_per_key(rows, self.key, self.order)


def run_stream_merge(spark: SparkSession, landing: str, row_schema: StructType, table_path: str,
                     checkpoint: str, key: str, order: list[str], prepare=None,
                     max_files_per_trigger: int | None = None) -> LatestTable:
    """Consume everything landed so far, merge it, stop. Returns the table.

    ``order`` names the columns that say which row of a key is the latest, the
    time first; rows that are equal in all of them are interchangeable.
    """
    table = LatestTable(spark, table_path, key, order)
    reader = spark.readStream.schema(page_schema(row_schema)).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = page_rows(reader.json(landing))
    latest = latest_per_key(prepare(rows) if prepare else rows, key, order)
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        q = (latest.writeStream.outputMode("update").foreachBatch(table.write_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)
    return table
