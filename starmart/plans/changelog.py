"""Stateful operators run over the driver's ``events`` table as a change log.

``events`` plays the feed of customer updates: key ``user_id``, tracked
attributes ``event_type`` and ``value``, change time ``ts``, arriving in
daily batches. Every function reads the whole table.

The "run date" (the last day present) is read back as one scalar — it is a
parameter of a batch run, like a scheduler's logical date, not data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starmart.operators import dims, merge, staging
from starmart.operators.scd2 import current_rows, latest_per_key, scd2_backfill, scd2_snapshot
from starmart.operators.scd2_store import Scd2Store
from starmart.plans.bucketed import BucketTable
from starmart.plans.warehouse import Warehouse
from starmart.session import freed_shuffles, scratch_path
from starmart.sources.lake import to_lake
from starmart.sources.landing import normalize_names, read_pages, write_pages
from starmart.sources.runs import RunLanding
from starmart.sources.tables import Tables
from starmart.sources.testmap import SNAPSHOT_TS, TestMap
from starmart.streaming.stream_merge import run_stream_merge

KEY = "user_id"
TRACKED = ["user_id", "event_type", "value", "updated_at"]
PAGE_SIZE = 100
#: Buckets of the keyed tables here.
BUCKETS = 8
#: Files a micro-batch takes, so that a run has several.
STREAM_FILES = 100


def changes(t: Tables) -> DataFrame:
    """The change log: one row per event."""
    return t.events.select("event_id", KEY, "event_type", F.col("value").cast("decimal(18,2)").alias("value"),
                           F.col("ts").alias("updated_at"), F.col("ts").cast("date").alias("batch_day"))


def last_day(t: Tables):
    return t.events.agg(F.max(F.col("ts").cast("date"))).first()[0]


CHANGE_COLUMNS = ["event_id", KEY, "event_type", "value", "updated_at"]


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-6: the days before the last one loaded into an empty bucketed table,
    then the last day upserted into the buckets it touches. Equals the latest
    change of every key."""
    t = Tables(spark, sf_dir)
    c = changes(t)
    day = last_day(t)
    table = BucketTable(spark, scratch_path(spark, "upsert"), KEY, BUCKETS)
    order = ["updated_at", "event_id"]
    table.upsert(c.where(F.col("batch_day") < F.lit(day)).select(*CHANGE_COLUMNS), order=order)
    table.upsert(c.where(F.col("batch_day") >= F.lit(day)).select(*CHANGE_COLUMNS), order=order)
    return table.read().select(*CHANGE_COLUMNS)


def load_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-1/I-5/I-6 over columns that come and go: events land in two runs; the
    first lacks ``props``, the second lacks ``eventType`` and brings a nested
    ``detail``. The table ends with the union of the columns, a key of both
    runs with the first run's type and the second run's other values."""
    t = Tables(spark, sf_dir)
    pages = _event_pages(t).withColumn("id", F.col("userId"))
    day = F.to_date(F.col("updatedAt").cast("timestamp_ntz"))
    last = F.lit(last_day(t))
    root = scratch_path(spark, "drift")
    table = BucketTable(spark, f"{root}/table", buckets=BUCKETS)
    runs = {"first": pages.where(day < last).drop("props"),
            "second": pages.where(day >= last).drop("eventType").withColumn("detail", F.struct(F.col("value").alias("amount"), F.col("props")))}
    marks = merge.empty_marks(spark)
    for run, rows in runs.items():
        write_pages(rows, f"{root}/{run}", page_size=PAGE_SIZE)
        marks = merge.load_into(table, normalize_names(read_pages(spark, f"{root}/{run}", arrival=True)), marks, "events")
    detail = F.from_json("detail", "amount string, props string")
    return table.read().select(
        F.col(KEY).cast("bigint").alias(KEY), "event_type", F.col("value").cast("decimal(18,2)").alias("value"), "props",
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"), detail["amount"].cast("decimal(18,2)").alias("detail_amount"), detail["props"].alias("detail_props"))


def _entity_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = TestMap(Tables(spark, sf_dir)).staged()
    new = [merge.batch_mark(entity, staged[entity]) for entity in staging.LOAD_ORDER]
    return merge.save_marks(merge.empty_marks(spark), reduce(DataFrame.unionByName, new))


def high_water_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-3/I-4: the mark of each of the nine entities after a full load, and
    the bound the next incremental run will use."""
    return merge.safe_marks(_entity_marks(spark, sf_dir))


def incremental_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-2: after a load of every day but the last, the rows the next run
    re-reads: everything changed at or after ``mark - 1 day``."""
    t = Tables(spark, sf_dir)
    c = changes(t).drop("batch_day")
    first = c.where(F.col("updated_at").cast("date") < F.lit(last_day(t)))
    marks = merge.save_marks(merge.empty_marks(spark), merge.batch_mark("events", first))
    return merge.incremental_filter(c, merge.read_mark(marks, "events"))


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD-1 closed form: one snapshot run per day, replayed in one pass."""
    c = changes(Tables(spark, sf_dir))
    return scd2_backfill(c, KEY, "batch_day", tracked=TRACKED, arrival="event_id")


def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD-1 operator: history of every day but the last, then one snapshot
    run against the current state of the source (latest change per key)."""
    t = Tables(spark, sf_dir)
    c = changes(t)
    day = last_day(t)
    before = scd2_backfill(c.where(F.col("batch_day") < F.lit(day)), KEY, "batch_day",
                           tracked=TRACKED, arrival="event_id")
    state = merge.upsert(None, c.select("event_id", *TRACKED), key=KEY, order=["updated_at", "event_id"])
    return scd2_snapshot(before, state.select(*TRACKED), KEY, tracked=TRACKED)


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD-4: the open version of every key."""
    return current_rows(scd2_incremental(spark, sf_dir))


# -- customers with several versions -------------------------------------------

FIRST_DAY = SNAPSHOT_TS[:10]


def customer_changes(t: Tables) -> DataFrame:
    """The customers as first loaded, then one row per event, which gives its
    user another tier. ``batch_day`` is the day a snapshot run sees the row."""
    own = TestMap(t).customers()
    first = own.select(*dims.CUSTOMER_TRACKED, F.lit(-1).cast("bigint").alias("event_id"), F.lit(FIRST_DAY).cast("date").alias("batch_day"))
    e = t.events.select("user_id", "event_id", F.col("event_type").alias("_tier"), F.col("ts").alias("_at"))
    values = {"customer_id": F.col("user_id"), "tier": F.col("_tier"), "is_deleted": F.lit(False), "updated_at": F.col("_at")}
    later = e.join(own, F.col("user_id") == F.col("customer_id"), "left").select(
        *[values.get(c, F.col(c)).alias(c) for c in dims.CUSTOMER_TRACKED], "event_id", F.col("_at").cast("date").alias("batch_day"))
    return first.unionByName(later)


def customer_store(spark: SparkSession, sf_dir: str) -> Scd2Store:
    """A snapshot store after two steps: the history up to the day before the
    last one, and a run over the last day's batch, from which the customers that
    didn't change that day are absent (SCD-3: they stay open)."""
    t = Tables(spark, sf_dir)
    c, day = customer_changes(t), last_day(t)
    store = Scd2Store(spark, scratch_path(spark, "customer-history"))
    store.load(scd2_backfill(c.where(F.col("batch_day") < F.lit(day)), "customer_id", "batch_day", tracked=dims.CUSTOMER_TRACKED, arrival="event_id"))
    last = latest_per_key(c.where(F.col("batch_day") >= F.lit(day)), "customer_id", ["updated_at", "event_id"])
    store.run(last, "customer_id", dims.CUSTOMER_TRACKED, source_unique=True)
    return store


def _with_history(spark: SparkSession, sf_dir: str) -> Warehouse:
    tm = TestMap(Tables(spark, sf_dir))
    return Warehouse(tm.staged(), tm.calendar_bounds(), snapshots={"customer": customer_store(spark, sf_dir).history()})


def dim_customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-1/SCD-1 to SCD-4 with several versions a customer."""
    return _with_history(spark, sf_dir).dim_customer


def fct_payments_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-2/J-2 over customers with several versions: each payment meets the
    current one."""
    return _with_history(spark, sf_dir).fct_payments


# -- landing, staging and streaming --------------------------------------------

def _event_pages(t: Tables) -> DataFrame:
    """Events as API rows: camelCase names, text timestamps with 'Z'."""
    return t.events.select(
        F.col("event_id").cast("string").alias("id"), F.col("user_id").cast("string").alias("userId"),
        F.col("event_type").alias("eventType"), F.col("value").cast("decimal(18,2)").cast("string").alias("value"),
        F.col("props"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("updatedAt"))


EVENT_ROW = StructType([StructField(n, StringType()) for n in
                        ("id", "userId", "eventType", "value", "props", "updatedAt")])


def _typed_events(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("id").cast("bigint").alias("event_id"), F.col(KEY).cast("bigint").alias(KEY),
                       F.col("event_type"), F.col("value").cast("decimal(18,2)").alias("value"),
                       F.col("props"), F.col("updated_at").cast("timestamp_ntz").alias("updated_at"))


def landing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-1/I-8/I-9: land events as 100-row pages, read every page back."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "landing")
    write_pages(_event_pages(t), path, F.floor(F.col("id").cast("bigint") / PAGE_SIZE), PAGE_SIZE)
    return _typed_events(normalize_names(read_pages(spark, path, EVENT_ROW)))


LATE_USERS = 4


def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-2/I-7 from a landing in extract runs: two runs land and are loaded; then
    a third one lands, and pages of the first one that come late (those of one in
    ``LATE_USERS`` users). The second load reads these alone, and all events end
    in the table: the latest change of every user."""
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "runs")
    last = F.lit(last_day(t))
    day = F.to_date(F.col("updatedAt").cast("timestamp_ntz"))
    late = F.pmod(F.xxhash64("userId"), F.lit(LATE_USERS)) == 0
    pages = _event_pages(t).withColumn("late", late)
    third, second = day >= last, (day < last) & (day >= F.date_sub(last, 7))
    table = BucketTable(spark, f"{root}/table", "user_id", BUCKETS)
    landing = RunLanding(spark, f"{root}/landing", f"{root}/consumed")
    land = lambda rows, to: write_pages(rows.drop("late"), f"{landing.path}/{to}", page_size=PAGE_SIZE)
    order = ["updated_at", "event_id"]

    land(pages.where(~second & ~third & ~F.col("late")), "run=1/on-time")
    land(pages.where(second), "run=2/on-time")
    landing.load(table, order=order, prepare=_typed_rows)
    land(pages.where(third), "run=3/on-time")
    land(pages.where(~second & ~third & F.col("late")), "run=1/late")
    landing.load(table, order=order, prepare=_typed_rows)
    return table.read().select(*CHANGE_COLUMNS)


def _typed_rows(rows: DataFrame) -> DataFrame:
    return _typed_events(normalize_names(rows))


def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-1: daily page files streamed, a few days a micro-batch, into the latest
    change of every key."""
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "stream")
    landing = f"{root}/landing"
    pages = _event_pages(t)
    day = F.to_date(F.col("updatedAt").cast("timestamp_ntz"))
    # one folder of page files per day
    (pages.withColumn("_page", F.floor(F.col("id").cast("bigint") / PAGE_SIZE))
     .groupBy(day.alias("day"), "_page")
     .agg(F.collect_list(F.struct(*pages.columns)).alias("data"))
     .select("day", F.to_json(F.struct("data")).alias("value"))
     .write.mode("overwrite").partitionBy("day").text(landing))
    table = run_stream_merge(spark, f"{landing}/*/", EVENT_ROW, f"{root}/table", f"{root}/checkpoint",
                             key=KEY, order=["updated_at", "event_id"], prepare=_typed_events, max_files_per_trigger=STREAM_FILES)
    return table.read().select(*CHANGE_COLUMNS)


def stg_cast(entity: str):
    """ST-*: an entity landed as lake text (uuid keys, ISO timestamps,
    'True'/'False'), then cast back by the staging model."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        staged = TestMap(Tables(spark, sf_dir)).staged()[entity]
        return staging.stage(entity, to_lake(entity, staged))
    q.__name__ = f"stg_cast_{entity}"
    return q


def daily_run_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-7/I-12/I-13 end to end: every entity landed as API pages, then the
    daily run (load → stage → snapshot → marts → test); returns its 58 check
    results, which must equal the suite over the same tables."""
    from starmart.plans.pipeline import DailyRun
    from starmart.sources.lake import land_entity
    tm = TestMap(Tables(spark, sf_dir))
    staged = tm.staged()
    root = scratch_path(spark, "daily")
    with freed_shuffles(spark):
        for entity in staging.LOAD_ORDER:
            land_entity(staged[entity], entity, f"{root}/landing/{entity}")
    result = DailyRun(spark, f"{root}/warehouse", calendar=tm.calendar_bounds()).build(f"{root}/landing", run_id=1)
    return result.quality.select("test", "model", "column_name", "failures")
