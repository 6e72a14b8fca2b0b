"""The mart layer as one lazy graph.

``Warehouse`` wires staged entities → snapshots → dimensions → facts →
reports. Every property is a lazy DataFrame; nothing runs until an action,
so a report built from it reads only the columns and tables it needs.
``plans.pipeline`` materialises the same graph as versioned Parquet.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from starmart.operators import dims, facts, reports
from starmart.operators.scd2 import scd2_snapshot

MART_NAMES = ("dim_date", "dim_store", "dim_employee", "dim_payment_method", "dim_customer",
              "dim_product", "fct_sales", "fct_payments", "fct_inventory_daily",
              "fct_order_lifecycle", "flagged_payments")


class Warehouse:
    def __init__(self, staged: dict[str, DataFrame], calendar_bounds: DataFrame,
                 customer_history: DataFrame | None = None,
                 product_history: DataFrame | None = None,
                 holidays=dims.HOLIDAYS, snapshots: dict[str, DataFrame] | None = None,
                 keyed_sources: bool = True):
        """``customer_history``/``product_history``: history before this run
        (the snapshot runs here); ``snapshots``: histories already updated by
        a snapshot store (used as they are); ``keyed_sources``: the staged
        entities come from keyed tables (one row per natural key)."""
        self.staged = staged
        self.bounds = calendar_bounds
        self._customer_history = customer_history
        self._product_history = product_history
        self.holidays = holidays
        self._snapshots = snapshots or {}
        self.keyed_sources = keyed_sources

    # snapshots ------------------------------------------------------------
    @cached_property
    def snap_customer(self) -> DataFrame:
        if "customer" in self._snapshots:
            return self._snapshots["customer"]
        return scd2_snapshot(self._customer_history, self.staged["customers"], "customer_id",
                             tracked=dims.CUSTOMER_TRACKED, source_unique=self.keyed_sources)

    @cached_property
    def snap_product(self) -> DataFrame:
        if "product" in self._snapshots:
            return self._snapshots["product"]
        return scd2_snapshot(self._product_history, self.staged["products"], "product_id",
                             tracked=dims.PRODUCT_TRACKED, source_unique=self.keyed_sources)

    # dimensions -------------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.bounds, self.holidays)

    @cached_property
    def dim_store(self) -> DataFrame:
        return dims.dim_store(self.staged["stores"])

    @cached_property
    def dim_employee(self) -> DataFrame:
        return dims.dim_employee(self.staged["employees"])

    @cached_property
    def dim_payment_method(self) -> DataFrame:
        return dims.dim_payment_method(self.staged["payment_methods"])

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.dim_customer(self.snap_customer)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self.snap_product)

    # facts ------------------------------------------------------------------
    def _orders(self, columns=None, status_not: str | None = None) -> DataFrame:
        """Staged orders; a source that can leave out what isn't read is told so."""
        pick = getattr(self.staged, "orders", None)
        return pick(columns, status_not) if pick else self.staged["orders"]

    def sales(self, *keys: str) -> DataFrame:
        """``fct_sales`` with these surrogate keys only."""
        orders = self._orders(facts.sales_order_columns(keys), status_not=facts.CANCELLED)
        return facts.fct_sales(self.staged["order_items"], orders, self.dim_customer, self.dim_product,
                               self.dim_store, self.dim_employee, self.dim_date, keys)

    def payments(self, *keys: str) -> DataFrame:
        """``fct_payments`` with these surrogate keys only."""
        return facts.fct_payments(self.staged["payments"], self._orders(["order_id", "store_id"]),
                                  self.dim_customer, self.dim_store, self.dim_payment_method,
                                  self.dim_date, keys)

    def lifecycle(self, *keys: str) -> DataFrame:
        """``fct_order_lifecycle`` with these surrogate keys only."""
        return facts.fct_order_lifecycle(self._orders(facts.lifecycle_order_columns(keys)), self.dim_customer, self.dim_store,
                                         self.dim_employee, self.dim_date, keys)

    @cached_property
    def fct_sales(self) -> DataFrame:
        return self.sales(*facts.SALES_KEYS)

    @cached_property
    def fct_payments(self) -> DataFrame:
        return self.payments(*facts.PAYMENT_KEYS)

    @cached_property
    def fct_inventory_daily(self) -> DataFrame:
        return facts.fct_inventory_daily(self.staged["inventory_movements"], self.dim_date,
                                         self.dim_product, self.dim_store)

    @cached_property
    def fct_order_lifecycle(self) -> DataFrame:
        return self.lifecycle(*facts.LIFECYCLE_KEYS)

    @cached_property
    def flagged_payments(self) -> DataFrame:
        return facts.flagged_payments(self.staged["payments"])

    def marts(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in MART_NAMES}


class Reports:
    """R-1 … R-9 over any object exposing the marts as attributes. One that can
    build a fact with fewer lookups (a ``Warehouse``) is asked for those a report
    reads; stored marts are read as they are."""

    def __init__(self, marts):
        self.m = marts

    def _fact(self, name: str, build: str, *keys: str) -> DataFrame:
        narrow = getattr(self.m, build, None)
        return narrow(*keys) if narrow else getattr(self.m, name)

    def _sales(self, *keys: str) -> DataFrame:
        return self._fact("fct_sales", "sales", *keys)

    def _payments(self, *keys: str) -> DataFrame:
        return self._fact("fct_payments", "payments", *keys)

    def revenue_by_store(self):
        return reports.revenue_by_store(self._sales("store_sk"), self.m.dim_store)

    def revenue_by_category(self):
        return reports.revenue_by_category(self._sales("product_sk"), self.m.dim_product)

    def monthly_revenue(self):
        return reports.monthly_revenue(self._sales("date_key"), self.m.dim_date)

    def customer_segments(self):
        life = self._fact("fct_order_lifecycle", "lifecycle", "customer_sk")
        return reports.customer_segments(life, self.m.dim_customer)

    def top_products(self):
        return reports.top_products(self._sales("product_sk"), self.m.dim_product)

    def discount_bands(self):
        return reports.discount_bands(self._sales())

    def payment_methods(self):
        return reports.payment_methods(self._payments("payment_method_sk"), self.m.dim_payment_method)

    def flagged_breakdown(self):
        return reports.flagged_breakdown(self.m.flagged_payments)

    def refunds(self):
        return reports.refunds(self._payments())


REPORT_NAMES = ("revenue_by_store", "revenue_by_category", "monthly_revenue", "customer_segments",
                "top_products", "discount_bands", "payment_methods", "flagged_breakdown", "refunds")

