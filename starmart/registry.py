"""Registered queries: name → ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables under ``sf_dir`` (or data Spark derives
from them) in full.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.operators import quality
from starmart.plans import changelog, colocated, daily_reports, in_flight, inventory
from starmart.plans.warehouse import MART_NAMES, REPORT_NAMES, Reports, Warehouse
from starmart.session import scratch_path
from starmart.sources.tables import Tables, app_id
from starmart.sources.testmap import TestMap

Query = Callable[[SparkSession, str], DataFrame]


_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The lazy mart graph over ``sf_dir``; built once per Spark application
    (plan objects only — every query still runs from the Parquet files)."""
    key = (app_id(spark), sf_dir.rstrip("/"))
    w = _WAREHOUSES.get(key)
    if w is None:
        tm = TestMap(Tables(spark, sf_dir))
        w = _WAREHOUSES[key] = Warehouse(tm.staged(), tm.calendar_bounds())
    return w


def _mart(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(warehouse(spark, sf_dir), name)
    q.__name__ = name
    return q


def _report(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Reports(warehouse(spark, sf_dir)), name)()
    q.__name__ = name
    return q


QUALITY = {
    "quality_suite": quality.run_suite,
    "quality_not_null": quality.not_null_checks,
    "quality_unique": quality.unique_checks,
    "quality_relationships": quality.relationship_checks,
    "quality_rules": quality.rule_checks,
}


def _quality(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return QUALITY[name](warehouse(spark, sf_dir).marts())
    q.__name__ = name
    return q


def quality_in_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite as the daily run makes it: each mart computed and written once."""
    return in_flight.write_and_test(spark, warehouse(spark, sf_dir).marts(), scratch_path(spark, "marts"))


CHANGELOG: dict[str, Query] = {
    "upsert_latest": changelog.upsert_latest,
    "load_drift": changelog.load_drift,
    "high_water_marks": changelog.high_water_marks,
    "incremental_overlap": changelog.incremental_overlap,
    "incremental_runs": changelog.incremental_runs,
    "scd2_history": changelog.scd2_history,
    "scd2_incremental": changelog.scd2_incremental,
    "scd2_current": changelog.scd2_current,
    "dim_customer_history": changelog.dim_customer_history,
    "fct_payments_history": changelog.fct_payments_history,
    "landing_pages": changelog.landing_pages,
    "stream_merge": changelog.stream_merge,
    "stg_cast_orders": changelog.stg_cast("orders"),
    "stg_cast_payments": changelog.stg_cast("payments"),
    "stg_cast_customers": changelog.stg_cast("customers"),
    "stg_cast_products": changelog.stg_cast("products"),
    "stg_cast_stores": changelog.stg_cast("stores"),
    "stg_cast_employees": changelog.stg_cast("employees"),
    "stg_cast_payment_methods": changelog.stg_cast("payment_methods"),
    "stg_cast_order_items": changelog.stg_cast("order_items"),
    "stg_cast_inventory_movements": changelog.stg_cast("inventory_movements"),
    "daily_run_quality": changelog.daily_run_quality,
}


#: Buckets of the tables that are joined on the order key here.
ORDER_BUCKETS = 16
COLOCATED = {"fct_sales": ("order_items", "orders"), "fct_payments": ("payments", "orders")}


def _colocated(name: str) -> Query:
    """A fact whose order join (J-1, J-6) runs over tables bucketed on the order key."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        w = warehouse(spark, sf_dir)
        own = colocated.by_order(spark, w.staged, scratch_path(spark, "colocated"), ORDER_BUCKETS, COLOCATED[name])
        return getattr(Warehouse(ChainMap(own, w.staged), w.bounds), name)
    q.__name__ = f"{name}_colocated"
    return q


def _daily(name: str) -> Query:
    """A report from daily states that unite over days."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return daily_reports.REPORTS[name](spark, warehouse(spark, sf_dir))
    q.__name__ = name
    return q


def fct_inventory_daily_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return inventory.maintained(spark, w.staged["inventory_movements"], w.dim_date, w.dim_product, w.dim_store)


def payment_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return quality.payment_conservation(w.staged["payments"], w.fct_payments, w.flagged_payments)


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for n in REPORT_NAMES:
        out[n] = _report(n)
    for n in MART_NAMES:
        out[n] = _mart(n)
    for n in QUALITY:
        out[n] = _quality(n)
    for n in COLOCATED:
        out[f"{n}_colocated"] = _colocated(n)
    for n in daily_reports.REPORTS:
        out[n] = _daily(n)
    out["quality_in_flight"] = quality_in_flight
    out["fct_inventory_daily_maintained"] = fct_inventory_daily_maintained
    out["payment_conservation"] = payment_conservation
    out.update(CHANGELOG)
    return out
