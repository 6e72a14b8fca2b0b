"""Plan shape guards: what a query must never contain, and what must reach
the Parquet scan."""

import os

import pytest

import __spark_entry__ as E
from starmart import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_cross_products_or_python(spark, name):
    p = plan(E.queries()[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in p, f"{name}: {bad}"


def test_report_prunes_columns_and_pushes_filters(spark):
    p = plan(E.queries()["revenue_by_store"](spark, SF))
    # only the columns the report needs are read from lineitem and orders
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in p or \
        "struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in p
    assert "l_comment" not in p and "l_shipdate" not in p
    # unused dimensions are not joined at all
    assert "part.parquet" not in p and "supplier.parquet" not in p


def scans(df) -> set[str]:
    return {f.rsplit("/", 1)[-1].removesuffix(".parquet") for f in df.inputFiles()}


@pytest.mark.parametrize("name, tables", [
    ("revenue_by_category", {"lineitem", "orders", "part"}),
    ("top_products", {"lineitem", "orders", "part"}),
    ("discount_bands", {"lineitem", "orders"}),
    ("payment_methods", {"events"}),
    ("refunds", {"events"}),
])
def test_reports_join_only_what_they_read(spark, name, tables):
    assert scans(E.queries()[name](spark, SF)) == tables


def test_customer_segments_reads_no_store(spark):
    p = plan(E.queries()["customer_segments"](spark, SF))
    # customers: the fact's lookup and the report's own join, none for the store
    assert p.count("customer.parquet") == 2 and "nation.parquet" not in p


@pytest.mark.parametrize("name", ["fct_sales", "discount_bands"])
def test_cancelled_filter_is_pushed_to_the_orders_scan(spark, name):
    assert "Not(EqualTo(o_orderstatus,P))" in plan(E.queries()[name](spark, SF))


def test_hot_key_of_a_lookup_is_split(spark, tmp_dir):
    """80 % of a fact on one customer, dimension from Parquet: AQE splits the
    hot key, as the shuffle stands right below the join."""
    from pyspark.sql import functions as F

    from starmart.operators import facts

    spark.range(2000).select(F.col("id").alias("customer_id"), F.md5(F.col("id").cast("string")).alias("customer_sk"),
                             F.lit(True).alias("is_current")).write.parquet(f"{tmp_dir}/dim")
    spark.range(200000).select(F.when(F.col("id") % 5 == 0, F.col("id") % 2000).otherwise(7).alias("customer_id"),
                               F.sha2(F.col("id").cast("string"), 256).alias("x")).write.parquet(f"{tmp_dir}/fact")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact, dim = (spark.read.parquet(f"{tmp_dir}/{n}") for n in ("fact", "dim"))
        out = facts._lookup(fact, F.col("customer_id"), dim, "customer_id", "customer_sk", current_only=True)
        assert len(out.collect()) == 200000
        assert "skew=true" in plan(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
