"""The daily inventory, maintained by days (F-3).

Movements lie by the day they moved on, and so does the fact. A batch of new,
late or corrected movements changes the days it names and the days its
movements stood on before; a product with a new version changes the days it
moved on, as rows carry the current version's key. Only these days are read,
aggregated and replaced in the fact; the result equals a full rebuild.

The fact lies as its grain, sums and looked-up keys; the row's own key, a hash
of the grain, is made when it is read, not shuffled and written with every
batch. Days and stores are looked up where the rows are written. Movements that are all new are
added to their folders; a batch that corrects stored ones has their days
replaced. Ids that may be repeated are found by hashes of 8 bytes, and only
movements with such an id are grouped as whole rows.

A movement's row is the latest by ``updated_at`` (NULL is oldest), the batch's
among equal ones. A movement without an id can't be maintained and fails. The
table takes over first, then the fact: after a crash in between, running the
batch again finds the same days (its own), and ``rebuild`` makes all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.calendar import day_of
from starmart.functions.keys import packed, unpacked
from starmart.operators import facts
from starmart.plans.daily import DayTable, distinct_days
from starmart.session import discard_path, freed_shuffles, scratch_path

DAY = "movement_date"
KEY = "movement_id"
#: Hashes of repeated ids that are broadcast at most, 8 bytes each.
BROADCAST_HASHES = 1_000_000


class DailyInventory:
    def __init__(self, spark: SparkSession, path: str, movements: T.StructType, dim_date: DataFrame,
                 dim_product: DataFrame, dim_store: DataFrame, period: str = "month"):
        """``movements``: the columns of staged movements."""
        self.spark, self.path = spark, path.rstrip("/")
        self.dims = (dim_date, dim_product, dim_store)
        self.movements = DayTable(spark, f"{self.path}/movements", T.StructType([
            *(f for f in movements.fields if f.name != DAY), T.StructField(DAY, T.DateType())]), DAY, period)
        self.fact = DayTable(spark, f"{self.path}/fact", self._looked_up(self._sums()).schema, DAY, period)

    def _sums(self, days=None) -> DataFrame:
        sums = facts.inventory_products(facts.daily_movements(self.movements.read(days)), self.dims[1])
        return sums.withColumn("product_sk", packed("product_sk"))

    def _looked_up(self, sums: DataFrame) -> DataFrame:
        return facts.inventory_places(sums.withColumn("product_sk", unpacked("product_sk")), self.dims[0], self.dims[2])

    def read(self) -> DataFrame:
        return facts.inventory_rows(self.fact.read())

    def rebuild(self) -> None:
        """All days of the fact anew."""
        self.fact.replace(self._sums(), last=self._looked_up)

    def moved_on(self, ids: DataFrame, key: str) -> set:
        """The days on which movements with these ids stand now."""
        stored = self.movements.read().select(key, DAY)  # two columns of the table
        return distinct_days(stored.join(ids.select(key).distinct(), key, "left_semi"), DAY)

    def apply(self, batch: DataFrame, changed_products: DataFrame | None = None) -> set:
        """Take in a batch of staged movements (and the ids of products that got
        a new version); returns the days that were replaced."""
        new = batch.withColumn(DAY, day_of("moved_at")).select(*self.movements.schema.names)
        path = scratch_path(self.spark, "movements-batch")
        new.write.option("compression", "zstd").parquet(path)  # read several times below
        new = self.spark.read.schema(new.schema).parquet(path)
        if not new.where(F.col(KEY).isNull()).isEmpty():
            raise ValueError(f"movements without {KEY}")
        days = distinct_days(new, DAY) | self._take_in(new)
        if changed_products is not None:
            days |= self.moved_on(changed_products, "product_id")
        if days:
            self.fact.replace(self._sums(days), days, last=self._looked_up)
        discard_path(self.spark, path)
        return days

    def _take_in(self, new: DataFrame) -> set:
        """Take the batch into the movements; returns the days its movements stood on."""
        hashed, path = F.xxhash64(KEY).alias("hash"), scratch_path(self.spark, "movements-again")
        sides = self.movements.read().select(hashed, F.lit(0).alias("side")).unionByName(new.select(hashed, F.lit(1).alias("side")))
        with freed_shuffles(self.spark):  # ids that come twice in the batch or are stored, and any that share a hash
            (sides.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max("side").alias("side"))
             .where("n > 1 AND side = 1").select("hash").write.parquet(path))
        again = self.spark.read.schema("hash long").parquet(path)
        n = again.count()
        if n:
            stood = distinct_days(self.movements.read().select(DAY, hashed).join(_few(again, n), "hash", "left_semi"), DAY)
            self._replace(new, distinct_days(new, DAY) | stood, again, n)
        else:
            stood = set()
            self.movements.append(new)
        discard_path(self.spark, path)
        return stood

    def _replace(self, new: DataFrame, days: set, again: DataFrame, n: int) -> None:
        """The last row of each of the ``n`` repeated ids; all others as they are.
        Of many repeated ids, all rows are grouped: the hashes would move them too."""
        names, stored = self.movements.schema.names, self.movements.read(days)
        row = F.struct(*names).alias("row")

        def those(rows: DataFrame, how: str) -> DataFrame:
            if n > BROADCAST_HASHES:
                return rows if how == "left_semi" else rows.limit(0)
            return rows.withColumn("hash", F.xxhash64(KEY)).join(F.broadcast(again), "hash", how).select(*names)

        def aged(rows: DataFrame, side: int) -> DataFrame:
            return those(rows, "left_semi").select(F.col(KEY).alias("key"), row, F.struct("updated_at", F.lit(side).alias("side")).alias("age"))

        last = aged(stored, 0).unionByName(aged(new, 1)).groupBy("key").agg(F.max_by("row", "age").alias("row")).select("row.*")
        self.movements.replace(last.unionByName(those(new, "left_anti")), days, those(stored, "left_anti"))


def _few(hashes: DataFrame, n: int) -> DataFrame:
    return F.broadcast(hashes) if n <= BROADCAST_HASHES else hashes


def maintained(spark: SparkSession, staged: DataFrame, dim_date: DataFrame, dim_product: DataFrame,
               dim_store: DataFrame) -> DataFrame:
    """F-3 from two loads of all movements: adjustments arrive after the rest."""
    table = DailyInventory(spark, scratch_path(spark, "inventory-daily"), staged.schema, dim_date, dim_product, dim_store)
    late = F.coalesce(F.col("movement_type") == "adjustment", F.lit(False))
    table.apply(staged.where(~late))
    table.apply(staged.where(late))
    return table.read()
