"""Fact, dimension and quality semantics on tiny fixtures (FIXTURES §6-9)."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from starmart.operators import dims, facts, quality, reports
from starmart.plans.warehouse import Warehouse

from conftest import rows

D1 = dt.datetime(2024, 3, 1, 10, 0)


def staged(spark):
    """A small consistent world: 2 customers, 2 products, 1 store, 1 employee."""
    ts = D1
    cust = spark.createDataFrame(
        [(1, "Ann", None, None, None, "retail", "gold", None, None, None, None, None, False, ts, ts),
         (2, "Bob", None, None, None, "corporate", None, None, None, None, None, None, True, ts, ts)],
        "customer_id bigint, first_name string, last_name string, email string, phone string, segment string, "
        "tier string, address string, city string, state string, effective_from timestamp_ntz, "
        "registered_at timestamp_ntz, is_deleted boolean, created_at timestamp_ntz, updated_at timestamp_ntz")
    prod = spark.createDataFrame(
        [(10, "S1", "widget", "tools", None, "b", None, D("1.00"), D("2.00"), None, False, ts, ts),
         (11, "S2", "gadget", "toys", None, "b", None, D("1.00"), D("3.00"), None, False, ts, ts)],
        "product_id bigint, sku string, product_name string, category string, sub_category string, brand string, "
        "supplier string, cost_price decimal(18,2), selling_price decimal(18,2), effective_from timestamp_ntz, "
        "is_deleted boolean, created_at timestamp_ntz, updated_at timestamp_ntz")
    store = spark.createDataFrame([(100, "Main", "Lagos", None, None, None, None, None, ts, ts)],
                                  "store_id bigint, store_name string, city string, state string, address string, "
                                  "phone string, manager_name string, opened_date date, created_at timestamp_ntz, "
                                  "updated_at timestamp_ntz")
    emp = spark.createDataFrame([(7, 100, "Eve", None, None, None, None, False, ts, ts)],
                                "employee_id bigint, store_id bigint, first_name string, last_name string, "
                                "email string, role string, hired_date date, is_deleted boolean, "
                                "created_at timestamp_ntz, updated_at timestamp_ntz")
    methods = spark.createDataFrame([(1, "Card", "Visa", True, ts, ts)],
                                    "payment_method_id bigint, payment_method_name string, provider string, "
                                    "is_digital boolean, created_at timestamp_ntz, updated_at timestamp_ntz")
    o_schema = ("order_id bigint, customer_id bigint, store_id bigint, employee_id bigint, status string, "
                "discount_code string, discount_amount decimal(18,2), total_amount decimal(18,2), "
                "ordered_at timestamp_ntz, paid_at timestamp_ntz, shipped_at timestamp_ntz, "
                "delivered_at timestamp_ntz, cancelled_at timestamp_ntz, created_at timestamp_ntz, "
                "updated_at timestamp_ntz")
    late = dt.datetime(2030, 1, 1)
    orders = spark.createDataFrame([
        (1000, 1, 100, 7, "delivered", None, None, D("10.00"), D1, D1, D1, D1 + dt.timedelta(days=2), None, ts, ts),
        (1001, 2, 100, 7, "cancelled", None, None, D("5.00"), D1, None, None, None, D1, ts, ts),
        (1002, 1, 100, 7, None, None, None, D("7.00"), D1, None, None, None, None, ts, ts),
        (1003, 1, 100, 7, "paid", None, None, D("1.00"), late, None, None, D1, None, ts, ts),
    ], o_schema)
    i_schema = ("order_item_id string, order_id bigint, product_id bigint, quantity int, unit_price decimal(18,2), "
                "discount_pct decimal(5,2), line_total decimal(18,2), created_at timestamp_ntz, updated_at timestamp_ntz")
    pcts = [D("0"), D("0.5"), D("10"), D("10.01"), D("20"), D("20.01"), None]
    items = spark.createDataFrame(
        [(f"i{n}", 1000, 10, 1, D("1.00"), p, D("1.00"), ts, ts) for n, p in enumerate(pcts)] +
        [("x1", 1001, 10, 1, D("1.00"), D("0"), D("1.00"), ts, ts),      # cancelled
         ("x2", 1002, 10, 1, D("1.00"), D("0"), D("1.00"), ts, ts),      # NULL status
         ("x3", 9999, 10, 1, D("1.00"), D("0"), D("1.00"), ts, ts),      # no order
         ("x4", 1003, 11, 2, D("1.50"), D("0"), D("3.00"), ts, ts)],     # outside calendar
        i_schema)
    p_schema = ("payment_id bigint, order_id bigint, customer_id bigint, payment_method_id bigint, "
                "amount_paid decimal(18,2), currency string, status string, payment_type string, reference string, "
                "paid_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz")
    pays = spark.createDataFrame([
        (1, 1000, 1, 1, D("10.00"), "NGN", "ok", "payment", None, D1, ts, ts),
        (2, 1000, 1, 1, D("0.00"), "NGN", "ok", "payment", None, D1, ts, ts),      # zero
        (3, 1000, 1, 1, D("-2.00"), "NGN", "ok", "payment", None, D1, ts, ts),     # unexplained negative
        (4, 1000, 1, 1, D("-3.00"), "NGN", "ok", "refund", None, D1, ts, ts),      # refund
        (5, 1000, 1, 1, None, "NGN", "ok", "payment", None, D1, ts, ts),           # NULL amount: neither
        (6, 1000, 1, 1, D("-4.00"), "NGN", "ok", None, None, D1, ts, ts),          # NULL type: neither
    ], p_schema)
    m_schema = ("movement_id string, product_id bigint, store_id bigint, movement_type string, quantity int, "
                "reference_id string, reference_type string, notes string, moved_at timestamp_ntz, "
                "created_at timestamp_ntz, updated_at timestamp_ntz")
    moves = spark.createDataFrame([
        ("m1", 10, 100, "in", 5, None, None, None, D1, ts, ts),
        ("m2", 10, 100, "out", 2, None, None, None, D1, ts, ts),
        ("m3", 10, 100, "adjustment", 9, None, None, None, D1, ts, ts),
        ("m4", 10, 100, "IN", 9, None, None, None, D1, ts, ts),
        ("m5", None, 100, "in", 1, None, None, None, D1, ts, ts),
    ], m_schema)
    return {"customers": cust, "products": prod, "stores": store, "employees": emp, "payment_methods": methods,
            "orders": orders, "order_items": items, "payments": pays, "inventory_movements": moves}


def world(spark):
    return Warehouse(staged(spark), dims.calendar_bounds(spark))


def test_dim_date_reference_calendar(spark):
    d = dims.dim_date(dims.calendar_bounds(spark))
    assert d.count() == 2192
    r = rows(d.where(F.col("date_key").isin(F.lit("2023-01-01").cast("date"), F.lit("2024-03-29").cast("date"))),
             ["date_key"])
    assert (r[0]["week"], r[0]["day_of_week"], r[0]["is_weekend"], r[0]["is_public_holiday"]) == (52, 0, True, True)
    assert r[0]["month_name"] == "January  " and r[0]["day_name"] == "Sunday   "
    assert r[1]["is_public_holiday"] is True and r[1]["quarter"] == 1
    assert d.where("is_public_holiday").count() == 24


def test_sales_drop_cancelled_null_status_and_orphans(spark):
    s = rows(world(spark).fct_sales, ["order_item_id"])
    assert sorted(r["order_item_id"] for r in s) == sorted([f"i{n}" for n in range(7)] + ["x4"])
    x4 = [r for r in s if r["order_item_id"] == "x4"][0]
    assert x4["date_key"] is None and x4["product_sk"] is not None   # 2030 is outside the calendar


def test_discount_bands_edges(spark):
    r = {x["discount_band"]: x["order_lines"] for x in rows(reports.discount_bands(world(spark).fct_sales))}
    assert r == {"No Discount": 2, "1-10%": 2, "11-20%": 2, "Above 20%": 2}


def test_payment_split_and_null_logic(spark):
    w = world(spark)
    clean = sorted(r["payment_id"] for r in w.fct_payments.collect())
    flagged = {r["payment_id"]: r["flag_reason"] for r in w.flagged_payments.collect()}
    assert clean == [1, 4]
    assert flagged == {2: "zero_amount", 3: "unexplained_negative"}
    # conservation: 6 payments = 2 clean + 2 flagged + 2 in neither (NULL logic)
    assert len(clean) + len(flagged) + 2 == 6


def test_inventory_types_case_sensitive(spark):
    r = rows(world(spark).fct_inventory_daily, ["product_sk"])
    by_product = {x["product_sk"] is None: x for x in r}
    assert (by_product[False]["quantity_in"], by_product[False]["quantity_out"],
            by_product[False]["net_movement"]) == (5, 2, 3)
    assert by_product[True]["quantity_in"] == 1   # NULL product keeps its grain row


def test_lifecycle_keeps_all_orders_and_roles(spark):
    r = {x["order_id"]: x for x in world(spark).fct_order_lifecycle.collect()}
    assert set(r) == {1000, 1001, 1002, 1003}
    assert r[1000]["delivered_date_key"] == dt.date(2024, 3, 3)
    assert r[1001]["paid_date_key"] is None


def test_quality_suite_passes_and_fails(spark):
    w = world(spark)
    res = {(x["test"], x["model"], x["column_name"]): x["failures"] for x in quality.run_suite(w.marts()).collect()}
    assert len(res) == 58
    # failing on purpose: unknown order date → NULL date_key; NULL product → NULL product_sk
    assert res[("not_null", "fct_sales", "date_key")] == 1
    assert res[("not_null", "fct_inventory_daily", "product_sk")] == 1
    assert res[("fct_order_lifecycle_ordered_before_delivered", "fct_order_lifecycle", None)] == 1
    # passing
    assert res[("unique", "fct_sales", "sales_sk")] == 0
    assert res[("relationships", "fct_sales", "customer_sk")] == 0
    assert res[("fct_payments_no_flagged_payments", "fct_payments", None)] == 0


def test_quality_detects_duplicates_orphans_negatives_and_leaks(spark):
    m = world(spark).marts()
    sales = m["fct_sales"]
    bad = dict(m)
    bad["fct_sales"] = (sales.unionByName(sales.limit(1))
                        .unionByName(sales.limit(1).withColumn("customer_sk", F.lit("orphan"))
                                     .withColumn("sales_sk", F.lit("neg")).withColumn("line_total", F.lit(-1).cast("decimal(18,2)"))))
    bad["fct_inventory_daily"] = m["fct_inventory_daily"].unionByName(
        m["fct_inventory_daily"].limit(1).withColumn("inventory_sk", F.lit("neg"))
        .withColumn("quantity_in", F.lit(-3).cast("bigint")))
    bad["fct_payments"] = m["fct_payments"].unionByName(
        m["flagged_payments"].select("payment_id").join(m["fct_payments"].drop("payment_id").limit(1)))
    res = {(x["test"], x["model"], x["column_name"]): x["failures"] for x in quality.run_suite(bad).collect()}
    assert res[("unique", "fct_sales", "sales_sk")] == 1
    assert res[("relationships", "fct_sales", "customer_sk")] == 1
    assert res[("fct_sales_no_negative_line_total", "fct_sales", None)] == 1
    assert res[("fct_payments_no_flagged_payments", "fct_payments", None)] == 2
    assert res[("fct_inventory_no_negative_quantity", "fct_inventory_daily", None)] == 1


def test_current_version_join_restates_history(spark):
    """A changed customer: facts join the current version only."""
    s = staged(spark)
    w1 = Warehouse(s, dims.calendar_bounds(spark))
    s2 = dict(s)
    s2["customers"] = s["customers"].withColumn(
        "segment", F.when(F.col("customer_id") == 1, "vip").otherwise(F.col("segment"))).withColumn(
        "updated_at", F.when(F.col("customer_id") == 1, F.lit(dt.datetime(2024, 4, 1))).otherwise(F.col("updated_at")))
    w2 = Warehouse(s2, dims.calendar_bounds(spark), customer_history=w1.snap_customer)
    assert w2.dim_customer.count() == 3
    seg = {r["segment"]: r["total_orders"] for r in
           reports.customer_segments(w2.fct_order_lifecycle, w2.dim_customer).collect()}
    assert seg.get("vip") == 3 and "retail" not in seg


def test_duplicate_dimension_row_fails_the_facts_unique_check(spark):
    s = staged(spark)
    s["stores"] = s["stores"].unionByName(s["stores"])
    w = Warehouse(s, dims.calendar_bounds(spark))
    found = quality.unique_checks({"fct_sales": w.fct_sales}, {"fct_sales": ["sales_sk"]}).first()
    assert found["failures"] > 0
