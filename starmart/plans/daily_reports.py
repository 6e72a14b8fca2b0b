"""Reports from daily states: a changed day is aggregated anew, alone (R-1, R-3, R-4).

For each day a ``DailyStates`` keeps, by the report's groups, the distinct ids
(``operators.distinct_states``) and the exact sums and counts of amounts. A
report unites the states of all days. When a day's facts change, only that day
is read from the fact and aggregated; the states of the other days in its folder
are copied, all others stay where they are. Reports read the states, which are
far fewer than the facts, instead of all facts.

Days without a date belong to the reports like any other group of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.decimal import exact_quotient, exact_ratio
from starmart.operators import distinct_states
from starmart.plans.daily import DayTable, distinct_days
from starmart.plans.warehouse import Warehouse
from starmart.session import scratch_path

DAY = "day"


class DailyStates:
    """States of one report below ``path``.

    ``fact``: rows with ``day``, the groups ``by``, the id columns ``ids`` and the
    amount columns ``amounts``; it is asked for one set of days at a time.
    """

    def __init__(self, fact: DayTable, path: str, by: list[str], ids: list[str], amounts: list[str]):
        self.fact, self.by, self.ids, self.amounts = fact, by, ids, amounts
        spark, path = fact.spark, path.rstrip("/")
        kinds = {f.name: f for f in fact.schema.fields}
        groups = [kinds[c] for c in by]
        self.sets = {c: DayTable(spark, f"{path}/distinct-{c}", T.StructType([
            *groups, T.StructField(DAY, T.DateType()), T.StructField(distinct_states.BUCKET, T.LongType()), T.StructField("positions", T.ArrayType(T.ShortType())),
            T.StructField("bitmap", T.BinaryType())]), DAY, fact.period) for c in ids}
        sums = [f for c in amounts for f in (T.StructField(f"sum_{c}", T.DecimalType(38, kinds[c].dataType.scale)),
                                             T.StructField(f"count_{c}", T.LongType()))]
        self.sums = DayTable(spark, f"{path}/sums", T.StructType([*groups, T.StructField(DAY, T.DateType()), *sums]), DAY, fact.period)

    def refresh(self, days=None) -> None:
        """Aggregate the given days anew (None: all days of the fact)."""
        rows, by = self.fact.read(days), [DAY, *self.by]
        for column, table in self.sets.items():
            table.replace(distinct_states.states(rows, by, column), days)
        kept = [f for c in self.amounts for f in (F.sum(c).cast(self.sums.schema[f"sum_{c}"].dataType).alias(f"sum_{c}"),
                                                  F.count(c).alias(f"count_{c}"))]
        self.sums.replace(rows.groupBy(*by).agg(*kept) if kept else rows.select(*by).distinct(), days)

    def result(self, by: list[str] | None = None, dates: DataFrame | None = None) -> DataFrame:
        """One row a group: ``n_<id>`` distinct ids, ``sum_`` and ``count_`` of the
        amounts. ``dates`` (``day`` and more columns) adds groups made of the day."""
        by = self.by if by is None else by
        dated = (lambda t: t.read().join(dates, DAY)) if dates is not None else DayTable.read
        out = dated(self.sums).groupBy(*by).agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.sum(f"{kind}_{c}").alias(f"{kind}_{c}") for c in self.amounts for kind in ("sum", "count")])
        for column, table in self.sets.items():
            counts = distinct_states.merged(dated(table), by, f"n_{column}").select(
                *[F.col(c).alias(f"_{c}") for c in by], f"n_{column}")
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
            out = out.join(counts, same, "left").drop(*[f"_{c}" for c in by]).fillna(0, [f"n_{column}"])
        return out.drop("_rows")


def _states(spark: SparkSession, rows: DataFrame, name: str, by: list[str], ids: list[str], amounts: list[str]) -> DailyStates:
    """The fact's columns that a report reads, written by day, and their states."""
    root = scratch_path(spark, name)
    fact = DayTable(spark, f"{root}/fact", rows.schema, DAY)
    fact.replace(rows)
    made = DailyStates(fact, f"{root}/states", by, ids, amounts)
    made.refresh()
    return made


def apply_days(states: DailyStates, changed: DataFrame) -> set:
    """Replace whole days of the fact by ``changed`` and refresh their states only."""
    days = distinct_days(changed, DAY)
    states.fact.replace(changed, days)
    states.refresh(days)
    return days


def _total(column: str) -> F.Column:
    return F.round(F.col(column), 2).cast("decimal(38,2)")


def revenue_by_store(spark: SparkSession, w: Warehouse) -> DataFrame:
    """R-1 from daily states."""
    rows = (w.sales("store_sk", "date_key").join(w.dim_store.select("store_sk", "store_name", "city"), "store_sk")
            .select(F.col("date_key").alias(DAY), "store_name", "city", "order_id", "line_total"))
    return (_states(spark, rows, "daily-stores", ["store_name", "city"], ["order_id"], ["line_total"]).result()
            .select("store_name", "city", _total("sum_line_total").alias("total_revenue"), F.col("n_order_id").alias("total_orders"))
            .orderBy(F.desc_nulls_first("total_revenue")))


def monthly_revenue(spark: SparkSession, w: Warehouse, months: int = 24) -> DataFrame:
    """R-3 from daily states: a month's orders are the union of its days' orders."""
    rows = w.sales("date_key").select(F.col("date_key").alias(DAY), "order_id", "line_total")
    dates = w.dim_date.select(F.col("date_key").alias(DAY), "year", "month")
    return (_states(spark, rows, "daily-months", [], ["order_id"], ["line_total"]).result(["year", "month"], dates)
            .select("year", "month", _total("sum_line_total").alias("monthly_revenue"), F.col("n_order_id").alias("orders"))
            .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month")).limit(months))


def customer_segments(spark: SparkSession, w: Warehouse) -> DataFrame:
    """R-4 from daily states: two distinct counts, an average and a ratio."""
    c = w.dim_customer.select("customer_sk", "customer_id", "segment")
    rows = (w.lifecycle("customer_sk", "ordered_date_key").join(c, "customer_sk")
            .select(F.col("ordered_date_key").alias(DAY), "segment", "order_id", "customer_id", "total_amount"))
    found = _states(spark, rows, "daily-segments", ["segment"], ["order_id", "customer_id"], ["total_amount"]).result()
    orders, customers = F.col("n_order_id"), F.col("n_customer_id")
    return (found.select("segment", orders.alias("total_orders"), customers.alias("total_customers"),
                         exact_quotient(F.col("sum_total_amount"), F.col("count_total_amount")).alias("avg_order_value"),
                         exact_ratio(orders, customers, 1).alias("orders_per_customer"))
            .orderBy(F.desc_nulls_first("total_orders")))


REPORTS = {"revenue_by_store_daily": revenue_by_store, "monthly_revenue_daily": monthly_revenue,
           "customer_segments_daily": customer_segments}
