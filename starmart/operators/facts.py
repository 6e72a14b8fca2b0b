"""Facts (F-1 … F-5).

Each dimension is cut down to ``(natural key, surrogate key)`` — with the
``is_current`` filter for type-2 dims — before it is joined, so a shuffle
carries two columns of the dim, not all of them. The dimension is joined as
it is: a second row for a natural key doubles the fact's rows, which the
fact's unique check then reports. No join is hinted: a tiny dim (stores,
methods, the calendar) is broadcast by its size estimate, a big one
(customers, products at scale) is shuffled, and AQE re-decides at runtime from
the real size of each side and splits a hot key.

``keys`` names the surrogate keys a caller reads; the others are neither
looked up nor returned.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.calendar import day_of
from starmart.functions.keys import surrogate_key

CANCELLED = "cancelled"
REFUND = "refund"
MOVE_IN, MOVE_OUT = "in", "out"


# The order column from which each surrogate key of an order's fact is looked up.
ORDER_KEYS = {"customer_sk": "customer_id", "store_sk": "store_id", "employee_sk": "employee_id"}
SALES_KEYS = ("customer_sk", "product_sk", "store_sk", "employee_sk", "date_key")
PAYMENT_KEYS = ("customer_sk", "store_sk", "payment_method_sk", "date_key")
LIFECYCLE_DATES = ("ordered", "paid", "shipped", "delivered")
LIFECYCLE_KEYS = (*ORDER_KEYS, *[f"{r}_date_key" for r in LIFECYCLE_DATES])


def _lookup(fact: DataFrame, on: Column, dim: DataFrame, natural: str, sk: str, alias: str | None = None,
            current_only: bool = False) -> DataFrame:
    """``fact`` with the surrogate key of its row in ``dim``, NULL without one."""
    if current_only:
        dim = dim.where(F.col("is_current"))
    keys = dim.select(F.col(natural).alias(f"_{sk}_nk"), F.col(sk).alias(f"_{sk}"))
    joined = fact.join(keys, on == keys[f"_{sk}_nk"], "left").drop(f"_{sk}_nk")
    return joined.withColumnRenamed(f"_{sk}", alias or sk)


def sales_order_columns(keys: Collection[str] = SALES_KEYS) -> list[str]:
    """The order columns that ``fct_sales`` reads for these keys."""
    return ["order_id", "status", *[c for k, c in ORDER_KEYS.items() if k in keys],
            *(["ordered_at"] if "date_key" in keys else [])]


def fct_sales(items: DataFrame, orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
              dim_store: DataFrame, dim_employee: DataFrame, dim_date: DataFrame,
              keys: Collection[str] = SALES_KEYS) -> DataFrame:
    """F-1: one row per order line of an order that is not cancelled.

    Lines with no order, or one with a NULL status, drop out with the cancelled
    ones. The customers and employees of the orders are looked up before the
    lines join them: an order goes through these shuffles once, not once a line.
    """
    o = orders.select(*[F.col(c).alias(f"o_{c}") for c in sales_order_columns(keys)]).where(F.col("o_status") != CANCELLED)
    if "customer_sk" in keys:
        o = _lookup(o, F.col("o_customer_id"), dim_customer, "customer_id", "customer_sk", current_only=True)
    if "employee_sk" in keys:
        o = _lookup(o, F.col("o_employee_id"), dim_employee, "employee_id", "employee_sk")
    f = items.join(o, items["order_id"] == o["o_order_id"])
    if "product_sk" in keys:
        f = _lookup(f, F.col("product_id"), dim_product, "product_id", "product_sk", current_only=True)
    if "store_sk" in keys:
        f = _lookup(f, F.col("o_store_id"), dim_store, "store_id", "store_sk")
    if "date_key" in keys:
        f = _lookup(f, day_of("o_ordered_at"), dim_date, "date_key", "date_key")
    return f.select(
        surrogate_key("order_item_id").alias("sales_sk"), "order_id", "order_item_id",
        *[k for k in SALES_KEYS if k in keys], "quantity", "unit_price", "discount_pct", "line_total")


def anomalous(amount: Column, ptype: Column) -> Column:
    """Zero, or negative without being a refund (three-valued, like SQL)."""
    return (amount == 0) | ((amount < 0) & (ptype != REFUND))


def fct_payments(payments: DataFrame, orders: DataFrame, dim_customer: DataFrame,
                 dim_store: DataFrame, dim_payment_method: DataFrame, dim_date: DataFrame,
                 keys: Collection[str] = PAYMENT_KEYS) -> DataFrame:
    """F-2: payments that are not anomalous. A NULL amount, or a negative one
    with a NULL type, is in neither this table nor the quarantine. Orders are
    joined for their store only."""
    f = payments.where(~anomalous(F.col("amount_paid"), F.col("payment_type")))
    if "customer_sk" in keys:
        f = _lookup(f, F.col("customer_id"), dim_customer, "customer_id", "customer_sk", current_only=True)
    if "store_sk" in keys:
        o = orders.select(F.col("order_id").alias("o_order_id"), F.col("store_id").alias("o_store_id"))
        f = f.join(o, F.col("order_id") == o["o_order_id"], "left")
        f = _lookup(f, F.col("o_store_id"), dim_store, "store_id", "store_sk")
    if "payment_method_sk" in keys:
        f = _lookup(f, F.col("payment_method_id"), dim_payment_method, "payment_method_id", "payment_method_sk")
    if "date_key" in keys:
        f = _lookup(f, day_of("paid_at"), dim_date, "date_key", "date_key")
    return f.select(
        surrogate_key("payment_id").alias("payment_sk"), "payment_id", "order_id",
        *[k for k in PAYMENT_KEYS if k in keys], "amount_paid", "currency", "status", "payment_type")


def flagged_payments(payments: DataFrame) -> DataFrame:
    """F-5: the quarantine, with the reason."""
    amount, ptype = F.col("amount_paid"), F.col("payment_type")
    reason = (F.when(amount == 0, "zero_amount")
              .when((amount < 0) & (ptype != REFUND), "unexplained_negative")
              .otherwise("other"))
    return payments.where(anomalous(amount, ptype)).select(
        surrogate_key("payment_id").alias("flagged_payment_sk"), "payment_id", "order_id",
        "customer_id", "amount_paid", "currency", "status", "payment_type",
        reason.alias("flag_reason"), "created_at")


def daily_movements(movements: DataFrame) -> DataFrame:
    """Pre-aggregation of F-3 (A-1, A-2): product × store × day.

    Runs before any join; the partial aggregate collapses rows map-side.
    Movement types other than 'in'/'out' (case-sensitive) count zero but still
    form a grain row.
    """
    qty, mtype = F.col("quantity"), F.col("movement_type")
    return movements.groupBy(day_of("moved_at").alias("movement_date"), "product_id", "store_id").agg(
        F.sum(F.when(mtype == MOVE_IN, qty).otherwise(0)).cast("bigint").alias("quantity_in"),
        F.sum(F.when(mtype == MOVE_OUT, qty).otherwise(0)).cast("bigint").alias("quantity_out"))


def fct_inventory_daily(movements: DataFrame, dim_date: DataFrame, dim_product: DataFrame,
                        dim_store: DataFrame, day: bool = False) -> DataFrame:
    """F-3. The grain key is ``md5(day|product|store)``: the reference's key has
    no separator and collides for variable-width ids. ``day`` keeps
    ``movement_date``, which has days outside the calendar too."""
    f = inventory_products(daily_movements(movements), dim_product)
    return inventory_rows(inventory_places(f, dim_date, dim_store), day)


def inventory_products(daily: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Daily sums with the current key of their product, a big dimension."""
    return _lookup(daily, F.col("product_id"), dim_product, "product_id", "product_sk", current_only=True)


def inventory_places(daily: DataFrame, dim_date: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Daily sums with the keys of their day and store, small dimensions."""
    f = _lookup(daily, F.col("movement_date"), dim_date, "date_key", "date_key")
    return _lookup(f, F.col("store_id"), dim_store, "store_id", "store_sk")


def inventory_rows(daily: DataFrame, day: bool = False) -> DataFrame:
    """The columns of F-3 from daily sums with their looked-up keys."""
    return daily.select(
        surrogate_key("movement_date", "product_id", "store_id").alias("inventory_sk"),
        "date_key", "product_sk", "store_sk", "quantity_in", "quantity_out",
        (F.col("quantity_in") - F.col("quantity_out")).alias("net_movement"),
        *(["movement_date"] if day else []))


def lifecycle_order_columns(keys: Collection[str] = LIFECYCLE_KEYS) -> list[str]:
    """The order columns that ``fct_order_lifecycle`` reads for these keys."""
    return ["order_id", *[c for k, c in ORDER_KEYS.items() if k in keys], "status", "total_amount",
            "discount_amount", *[f"{r}_at" for r in LIFECYCLE_DATES], "cancelled_at"]


def fct_order_lifecycle(orders: DataFrame, dim_customer: DataFrame, dim_store: DataFrame,
                        dim_employee: DataFrame, dim_date: DataFrame,
                        keys: Collection[str] = LIFECYCLE_KEYS) -> DataFrame:
    """F-4: accumulating snapshot of every order (cancelled included), the
    calendar joined in four roles."""
    f = orders
    if "customer_sk" in keys:
        f = _lookup(f, F.col("customer_id"), dim_customer, "customer_id", "customer_sk", current_only=True)
    if "store_sk" in keys:
        f = _lookup(f, F.col("store_id"), dim_store, "store_id", "store_sk")
    if "employee_sk" in keys:
        f = _lookup(f, F.col("employee_id"), dim_employee, "employee_id", "employee_sk")
    for role in LIFECYCLE_DATES:
        if f"{role}_date_key" in keys:
            f = _lookup(f, day_of(f"{role}_at"), dim_date, "date_key", "date_key", f"{role}_date_key")
    return f.select(
        surrogate_key("order_id").alias("lifecycle_sk"), "order_id", *[k for k in LIFECYCLE_KEYS if k in keys],
        "status", "total_amount", "discount_amount", "ordered_at", "paid_at", "shipped_at",
        "delivered_at", "cancelled_at")
