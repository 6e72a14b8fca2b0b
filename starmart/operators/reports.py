"""Business reports over the marts (R-1 … R-9).

Each takes the mart DataFrames and returns one result table. Aggregates are
two-phase (partial before the shuffle); the joins to a dimension are inner,
so facts whose key is NULL drop out, as in the reference. Sorting follows
Postgres: NULLs first on DESC, last on ASC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.decimal import exact_avg, exact_ratio, round_sum


def _dim(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


def revenue_by_store(fct_sales: DataFrame, dim_store: DataFrame) -> DataFrame:
    """R-1."""
    s = _dim(dim_store, "store_sk", "store_name", "city")
    return (fct_sales.join(s, "store_sk").groupBy("store_name", "city")
            .agg(round_sum("line_total").alias("total_revenue"),
                 F.countDistinct("order_id").alias("total_orders"))
            .orderBy(F.desc_nulls_first("total_revenue")))


def revenue_by_category(fct_sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """R-2."""
    p = _dim(dim_product, "product_sk", "category")
    return (fct_sales.join(p, "product_sk").groupBy("category")
            .agg(round_sum("line_total").alias("total_revenue"),
                 F.sum("quantity").cast("bigint").alias("units_sold"))
            .orderBy(F.desc_nulls_first("total_revenue")))


def monthly_revenue(fct_sales: DataFrame, dim_date: DataFrame, months: int = 24) -> DataFrame:
    """R-3: the first ``months`` months, oldest first."""
    d = _dim(dim_date, "date_key", "year", "month")
    return (fct_sales.join(d, "date_key").groupBy("year", "month")
            .agg(round_sum("line_total").alias("monthly_revenue"),
                 F.countDistinct("order_id").alias("orders"))
            .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"))
            .limit(months))


def customer_segments(fct_order_lifecycle: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """R-4: two exact distinct counts in one group, average and ratio.

    ``dim_customer`` holds every version, so customers are counted by
    natural id, not by rows.
    """
    c = _dim(dim_customer, "customer_sk", "customer_id", "segment")
    g = (fct_order_lifecycle.join(c, "customer_sk").groupBy("segment")
         .agg(F.countDistinct("order_id").alias("total_orders"),
              F.countDistinct("customer_id").alias("total_customers"),
              exact_avg("total_amount").alias("avg_order_value")))
    return (g.select("segment", "total_orders", "total_customers", "avg_order_value",
                     exact_ratio(F.col("total_orders"), F.col("total_customers"), 1)
                     .alias("orders_per_customer"))
            .orderBy(F.desc_nulls_first("total_orders")))


def top_products(fct_sales: DataFrame, dim_product: DataFrame, k: int = 10) -> DataFrame:
    """R-5: top-k by revenue (ties broken by name, category)."""
    p = _dim(dim_product, "product_sk", "product_name", "category")
    return (fct_sales.join(p, "product_sk").groupBy("product_name", "category")
            .agg(round_sum("line_total").alias("revenue"),
                 F.sum("quantity").cast("bigint").alias("units_sold"),
                 exact_avg("discount_pct").alias("avg_discount_pct"))
            .orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("product_name"),
                     F.asc_nulls_last("category"))
            .limit(k))


def discount_band(pct) -> F.Column:
    """P-5: NULL falls through to 'Above 20%'."""
    return (F.when(pct == 0, "No Discount").when(pct <= 10, "1-10%")
            .when(pct <= 20, "11-20%").otherwise("Above 20%"))


def discount_bands(fct_sales: DataFrame) -> DataFrame:
    """R-6."""
    return (fct_sales.groupBy(discount_band(F.col("discount_pct")).alias("discount_band"))
            .agg(F.count(F.lit(1)).alias("order_lines"),
                 round_sum("line_total").alias("revenue"),
                 exact_avg("line_total").alias("avg_line_value"))
            .orderBy(F.desc_nulls_first("revenue")))


def payment_methods(fct_payments: DataFrame, dim_payment_method: DataFrame) -> DataFrame:
    """R-7: sums mix currencies and statuses, as the reference does."""
    m = _dim(dim_payment_method, "payment_method_sk", "payment_method_name")
    return (fct_payments.join(m, "payment_method_sk").groupBy("payment_method_name")
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 round_sum("amount_paid").alias("total_amount"),
                 exact_avg("amount_paid").alias("avg_transaction"))
            .orderBy(F.desc_nulls_first("total_amount")))


def flagged_breakdown(flagged: DataFrame) -> DataFrame:
    """R-8."""
    return (flagged.groupBy("flag_reason")
            .agg(F.count(F.lit(1)).alias("count"), round_sum("amount_paid").alias("total_amount"))
            .orderBy(F.desc_nulls_first("count")))


def refunds(fct_payments: DataFrame) -> DataFrame:
    """R-9: negative amounts by payment type."""
    return (fct_payments.where(F.col("amount_paid") < 0).groupBy("payment_type")
            .agg(F.count(F.lit(1)).alias("count"), round_sum("amount_paid").alias("total_amount")))
