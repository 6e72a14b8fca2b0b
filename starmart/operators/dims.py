"""Dimensions (D-1 … D-6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import calendar as cal
from starmart.functions.keys import surrogate_key

# Tracked snapshot columns (SCD-5); created_at is not tracked.
CUSTOMER_TRACKED = ["customer_id", "first_name", "last_name", "email", "phone", "segment", "tier",
                    "address", "city", "state", "effective_from", "registered_at", "is_deleted",
                    "updated_at"]
PRODUCT_TRACKED = ["product_id", "sku", "product_name", "category", "sub_category", "brand",
                   "supplier", "cost_price", "selling_price", "effective_from", "is_deleted",
                   "updated_at"]

# Public holidays flagged in the calendar (8 a year, 2023-2025).
HOLIDAYS = (
    "2023-01-01", "2023-04-07", "2023-04-10", "2023-05-01", "2023-06-12", "2023-10-01",
    "2023-12-25", "2023-12-26",
    "2024-01-01", "2024-03-29", "2024-04-01", "2024-05-01", "2024-06-12", "2024-10-01",
    "2024-12-25", "2024-12-26",
    "2025-01-01", "2025-04-18", "2025-04-21", "2025-05-01", "2025-06-12", "2025-10-01",
    "2025-12-25", "2025-12-26",
)
CALENDAR_START = "2023-01-01"
CALENDAR_END = "2028-12-31"


def _is_current() -> Column:
    return F.col("valid_to").isNull().alias("is_current")


def dim_customer(history: DataFrame) -> DataFrame:
    """D-1: one row per customer version."""
    return history.select(
        surrogate_key("scd_id").alias("customer_sk"),
        "customer_id", "first_name", "last_name", "email", "phone", "segment", "tier",
        "address", "city", "state", "registered_at", "valid_from", "valid_to",
        _is_current(), "is_deleted")


def dim_product(history: DataFrame) -> DataFrame:
    """D-2: one row per product version (keeps effective_from)."""
    return history.select(
        surrogate_key("scd_id").alias("product_sk"),
        "product_id", "sku", "product_name", "category", "sub_category", "brand", "supplier",
        "cost_price", "selling_price", "effective_from", "valid_from", "valid_to",
        _is_current(), "is_deleted")


def dim_store(stores: DataFrame) -> DataFrame:
    return stores.select(surrogate_key("store_id").alias("store_sk"), "store_id", "store_name",
                         "city", "state", "address", "phone", "manager_name", "opened_date")


def dim_employee(employees: DataFrame) -> DataFrame:
    return employees.select(surrogate_key("employee_id").alias("employee_sk"), "employee_id",
                            "store_id", "first_name", "last_name", "email", "role",
                            "hired_date", "is_deleted")


def dim_payment_method(methods: DataFrame) -> DataFrame:
    return methods.select(surrogate_key("payment_method_id").alias("payment_method_sk"),
                          "payment_method_id", "payment_method_name", "provider", "is_digital")


def date_spine(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Every day between the bounds of each row of ``bounds`` (G-1)."""
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end),
                                              F.expr("INTERVAL 1 DAY"))).alias("date_day"))


def calendar_bounds(spark, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    return spark.range(1).select(F.lit(start).cast("date").alias("start_date"),
                                 F.lit(end).cast("date").alias("end_date"))


def dim_date(bounds: DataFrame, holidays=HOLIDAYS) -> DataFrame:
    """D-6: calendar with Postgres date parts, weekend and holiday flags.

    ``bounds`` is a one-row frame (start_date, end_date); the calendar is
    bounded by that span, a few thousand rows.
    """
    d = F.col("date_day")
    dow = cal.dow_sunday0(d)
    holiday = d.isin(*[F.lit(h).cast("date") for h in holidays]) if holidays else F.lit(False)
    return date_spine(bounds).select(
        d.alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        cal.month_name(d).alias("month_name"),
        cal.iso_week(d).alias("week"),
        dow.alias("day_of_week"),
        cal.day_name(d).alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
        holiday.alias("is_public_holiday"))
