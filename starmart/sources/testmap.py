"""The driver's tables seen as the nine staged retail entities.

Each function returns a DataFrame with exactly the columns of the matching
staging model, so the dimension/fact/report operators run unchanged on
either this mapping or real landed data (``operators.staging``). Natural keys
stay integers here (cheaper to hash and join than uuid text); every operator
is key-type agnostic.

Mapping:

* customers      ← ``customer``; segment = ``c_mktsegment``
* products       ← ``part``; name/category/brand = ``p_name``/``p_type``/``p_brand``
* stores         ← ``nation`` ⋈ ``region``; city = region name
* employees      ← ``supplier``; store = ``s_nationkey``
* orders         ← ``orders`` ⋈ ``customer`` (store = customer's nation) ⋈ per-order
                   line figures (employee = lowest supplier key, shipped/delivered
                   = first/last ship date, discount amount)
* order_items    ← ``lineitem``; composite key; ``discount_pct = l_discount*100``
* payments       ← ``events``; sign of the amount derived from the event type
* payment_methods← method ids seen in ``events`` ⋈ a fixed 5-row name list
* inventory      ← ``lineitem`` ⋈ ``supplier``; return flag R/A/N → in/out/other
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.dims import calendar_bounds
from starmart.sources.tables import Tables, app_id

MONEY = "decimal(18,2)"
PCT = "decimal(5,2)"

# Fixed values for the mapping.
# Dimension tables in the driver data carry no change time; they are loaded
# as one snapshot taken at this instant.
SNAPSHOT_TS = "2002-01-01 00:00:00"
# o_orderstatus → order status text; 'cancelled' is the value fct_sales drops.
ORDER_STATUS = {"F": "completed", "O": "pending", "P": "cancelled"}
# l_returnflag → inventory movement type.
MOVEMENT_TYPE = {"R": "in", "A": "out", "N": "adjustment"}
# event_type → payment type; a click is a refund.
PAYMENT_TYPE = {"click": "refund"}
# Sign of the payment amount per event type; others are negative.
POSITIVE_EVENTS = ("purchase", "view")
ZERO_EVENTS = ("signup",)
# Payment method id = props.k mod 5; names of the five methods.
PAYMENT_METHOD_COUNT = 5
PAYMENT_METHODS = [
    (0, "Cash", "In-store", False),
    (1, "Card", "Card network", True),
    (2, "Bank Transfer", "Bank", True),
    (3, "USSD", "Telco", True),
    (4, "Mobile Wallet", "Wallet", True),
]
CURRENCY = "USD"
PAYMENT_STATUS = "completed"


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def _snapshot_ts() -> Column:
    return F.lit(SNAPSHOT_TS).cast("timestamp_ntz")


def _map(col: Column, mapping: dict, default: Column | None = None) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v)))
    return out.otherwise(default if default is not None else _null("string"))


def _values_frame(spark, rows, names) -> DataFrame:
    """A small fixed table as an inline VALUES relation (planned JVM-side,
    no Python RDD)."""
    def lit(v):
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


def money(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast(MONEY)


def item_key() -> Column:
    """Unique line id: order, line number, part, supplier and ship day."""
    return F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                       F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                       F.col("l_shipdate").cast("date").cast("string"))


#: First and last fact date, per application and folder.
_BOUNDS: dict[tuple[str, str], tuple] = {}


class TestMap:
    __test__ = False  # not a pytest class

    def __init__(self, tables: Tables):
        self.t = tables
        self.spark = tables.spark

    # -- dimensions ------------------------------------------------------
    def customers(self) -> DataFrame:
        c = self.t.customer
        return c.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            _null("string").alias("last_name"),
            _null("string").alias("email"),
            _null("string").alias("phone"),
            F.col("c_mktsegment").alias("segment"),
            _null("string").alias("tier"),
            _null("string").alias("address"),
            _null("string").alias("city"),
            _null("string").alias("state"),
            _null("timestamp_ntz").alias("effective_from"),
            _null("timestamp_ntz").alias("registered_at"),
            F.lit(False).alias("is_deleted"),
            _snapshot_ts().alias("created_at"),
            _snapshot_ts().alias("updated_at"),
        )

    def products(self) -> DataFrame:
        p = self.t.part
        return p.select(
            F.col("p_partkey").alias("product_id"),
            _null("string").alias("sku"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            _null("string").alias("sub_category"),
            F.col("p_brand").alias("brand"),
            _null("string").alias("supplier"),
            _null(MONEY).alias("cost_price"),
            money("p_retailprice").alias("selling_price"),
            _null("timestamp_ntz").alias("effective_from"),
            F.lit(False).alias("is_deleted"),
            _snapshot_ts().alias("created_at"),
            _snapshot_ts().alias("updated_at"),
        )

    def stores(self) -> DataFrame:
        n, r = self.t.nation, self.t.region
        return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
            F.col("n_nationkey").cast("bigint").alias("store_id"),
            F.col("n_name").alias("store_name"),
            F.col("r_name").alias("city"),
            _null("string").alias("state"),
            _null("string").alias("address"),
            _null("string").alias("phone"),
            _null("string").alias("manager_name"),
            _null("date").alias("opened_date"),
            _snapshot_ts().alias("created_at"),
            _snapshot_ts().alias("updated_at"),
        )

    def employees(self) -> DataFrame:
        s = self.t.supplier
        return s.select(
            F.col("s_suppkey").alias("employee_id"),
            F.col("s_nationkey").cast("bigint").alias("store_id"),
            F.col("s_name").alias("first_name"),
            _null("string").alias("last_name"),
            _null("string").alias("email"),
            _null("string").alias("role"),
            _null("date").alias("hired_date"),
            F.lit(False).alias("is_deleted"),
            _snapshot_ts().alias("created_at"),
            _snapshot_ts().alias("updated_at"),
        )

    def payment_methods(self) -> DataFrame:
        seen = self.t.events.select(self._method_id().alias("payment_method_id")).distinct()
        names = _values_frame(self.spark, PAYMENT_METHODS,
                              ["payment_method_id", "payment_method_name", "provider", "is_digital"])
        names = names.withColumn("payment_method_id", F.col("payment_method_id").cast("bigint"))
        return seen.join(F.broadcast(names), "payment_method_id", "left").select(
            "payment_method_id", "payment_method_name", "provider", "is_digital",
            _snapshot_ts().alias("created_at"), _snapshot_ts().alias("updated_at"))

    # -- transactions ----------------------------------------------------
    def order_lines(self) -> DataFrame:
        """Per-order figures from its lines (one row per order key)."""
        li = self.t.lineitem
        return li.groupBy("l_orderkey").agg(
            F.min("l_suppkey").alias("line_employee_id"),
            F.min("l_shipdate").alias("first_ship"),
            F.max("l_shipdate").alias("last_ship"),
            F.round(F.sum(money("l_extendedprice") * F.col("l_discount").cast(PCT)), 2)
            .cast(MONEY).alias("line_discount"),
        )

    def orders(self, columns: Collection[str] | None = None, status_not: str | None = None) -> DataFrame:
        """Staged orders. With ``columns``, only those, and only the joins they need.

        ``status_not`` leaves out orders of that status by their raw code, a
        predicate that reaches the Parquet scan; the caller filters as well.
        """
        o = self.t.orders
        if status_not is not None:
            for code in [c for c, name in ORDER_STATUS.items() if name == status_not]:
                o = o.where(F.col("o_orderstatus") != code)
        day = F.col("o_orderdate")
        own = {
            "order_id": F.col("o_orderkey"),
            "customer_id": F.col("o_custkey"),
            "store_id": F.col("c_nationkey").cast("bigint"),
            "employee_id": F.col("line_employee_id"),
            "status": _map(F.col("o_orderstatus"), ORDER_STATUS),
            "discount_code": _null("string"),
            "discount_amount": F.col("line_discount"),
            "total_amount": money("o_totalprice"),
            "ordered_at": day,
            "paid_at": F.when(F.col("o_orderstatus") != "O", day),
            "shipped_at": F.col("first_ship"),
            "delivered_at": F.col("last_ship"),
            "cancelled_at": F.when(F.col("o_orderstatus") == "P", day),
            "created_at": day,
            "updated_at": day,
        }
        wanted = [c for c in own if columns is None or c in columns]
        if "store_id" in wanted:
            c = self.t.customer
            o = o.join(c, o.o_custkey == c.c_custkey, "left")
        if {"employee_id", "discount_amount", "shipped_at", "delivered_at"} & set(wanted):
            lines = self.order_lines()
            o = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
        return o.select(*[own[c].alias(c) for c in wanted])

    def order_items(self) -> DataFrame:
        li = self.t.lineitem
        price = money("l_extendedprice")
        qty = F.col("l_quantity").cast("int")
        return li.select(
            item_key().alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            qty.alias("quantity"),
            # exact decimal division, half-up to cents
            F.round(price / qty.cast("decimal(10,0)"), 2).cast(MONEY).alias("unit_price"),
            (F.col("l_discount").cast(PCT) * 100).cast(PCT).alias("discount_pct"),
            F.round(price * (F.lit(1) - F.col("l_discount").cast(PCT)), 2).cast(MONEY).alias("line_total"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_shipdate").alias("updated_at"),
        )

    def inventory_movements(self) -> DataFrame:
        li, s = self.t.lineitem, self.t.supplier
        return li.join(s, li.l_suppkey == s.s_suppkey, "left").select(
            item_key().alias("movement_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("s_nationkey").cast("bigint").alias("store_id"),
            _map(F.col("l_returnflag"), MOVEMENT_TYPE).alias("movement_type"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_orderkey").cast("string").alias("reference_id"),
            F.lit("order").alias("reference_type"),
            _null("string").alias("notes"),
            F.col("l_shipdate").alias("moved_at"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_shipdate").alias("updated_at"),
        )

    @staticmethod
    def _method_id() -> Column:
        k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
        return F.pmod(k, F.lit(PAYMENT_METHOD_COUNT))

    def payments(self) -> DataFrame:
        e = self.t.events
        v = money("value")
        amount = (F.when(F.col("event_type").isin(*POSITIVE_EVENTS), v)
                  .when(F.col("event_type").isin(*ZERO_EVENTS), F.lit(0).cast(MONEY))
                  .otherwise(-v))
        ptype = _map(F.col("event_type"), PAYMENT_TYPE, default=F.col("event_type"))
        return e.select(
            F.col("event_id").alias("payment_id"),
            F.col("event_id").alias("order_id"),
            F.col("user_id").alias("customer_id"),
            self._method_id().alias("payment_method_id"),
            amount.cast(MONEY).alias("amount_paid"),
            F.lit(CURRENCY).alias("currency"),
            F.lit(PAYMENT_STATUS).alias("status"),
            ptype.alias("payment_type"),
            F.col("props").alias("reference"),
            F.col("ts").alias("paid_at"),
            F.col("ts").alias("created_at"),
            F.col("ts").alias("updated_at"),
        )

    # -- calendar bounds -------------------------------------------------
    def calendar_bounds(self) -> DataFrame:
        """One row (start_date, end_date): whole years around every fact date.

        The two dates are read once per application and folder and stand in the
        plan as literals, so no query scans the fact tables for its calendar."""
        key = (app_id(self.spark), self.t.sf_dir)
        if key not in _BOUNDS:
            days = [self.t.orders.select(F.col("o_orderdate").cast("date").alias("d")), self.t.lineitem.select(F.col("l_shipdate").cast("date").alias("d")),
                    self.t.events.select(F.col("ts").cast("date").alias("d"))]
            _BOUNDS[key] = tuple(reduce(DataFrame.unionByName, days).agg(F.min("d"), F.max("d")).first())
        lo, hi = _BOUNDS[key]
        if lo is None:  # no facts, no calendar
            return calendar_bounds(self.spark).limit(0)
        return calendar_bounds(self.spark, f"{lo.year:04d}-01-01", f"{hi.year:04d}-12-31")

    def staged(self) -> "LazyStaged":
        return LazyStaged(self)


class LazyStaged(dict):
    """Entity name → staged DataFrame, built on first access only, so a query
    that needs two entities does not analyse the other seven."""

    NAMES = ("customers", "products", "stores", "employees", "orders", "order_items", "payments",
             "inventory_movements", "payment_methods")

    def __init__(self, tm: TestMap):
        super().__init__()
        self._tm = tm

    def orders(self, columns: Collection[str] | None = None, status_not: str | None = None) -> DataFrame:
        return self._tm.orders(columns, status_not)

    def __missing__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        df = getattr(self._tm, name)()
        self[name] = df
        return df
