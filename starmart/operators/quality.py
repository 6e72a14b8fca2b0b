"""Data-quality suite (Q-1 … Q-8).

The 58 checks are data (``NOT_NULL``, ``UNIQUE``, ``RELATIONSHIPS`` and the
four rules), not code. Each runner returns ``(test, model, column_name,
failures)`` rows:

* not_null: one aggregate pass per table counts the NULLs of every tested
  column at once, then ``inline`` turns the counts into rows;
* unique: values that occur more than once (NULLs ignored), counted with a
  two-level aggregate — partial counts before the shuffle;
* relationships: per child table its foreign keys are unpivoted and
  anti-joined once against the tagged parent keys (never multiplies rows);
* rules: the four business rules, each a filter + count.

``run_suite`` (Q-8) folds all checks of a table but the leak check into one
two-level aggregate, so the suite computes each table once instead of once per
check. Nothing is collected: the result is a small
DataFrame the caller can write, show or gate a publish on.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.keys import packed

RESULT_COLUMNS = ("test", "model", "column_name", "failures")


@dataclass(frozen=True)
class Relationship:
    model: str
    column: str
    to_model: str
    to_column: str


# The column tests of the star schema.
NOT_NULL = {
    "dim_date": ["date_key"],
    "dim_store": ["store_sk", "store_id"],
    "dim_employee": ["employee_sk", "employee_id"],
    "dim_payment_method": ["payment_method_sk"],
    "dim_customer": ["customer_sk", "customer_id"],
    "dim_product": ["product_sk", "product_id"],
    "fct_sales": ["sales_sk", "customer_sk", "product_sk", "store_sk", "employee_sk", "date_key"],
    "fct_payments": ["payment_sk", "customer_sk", "store_sk", "payment_method_sk", "date_key"],
    "fct_inventory_daily": ["inventory_sk", "product_sk", "store_sk", "date_key"],
    "fct_order_lifecycle": ["lifecycle_sk", "customer_sk", "store_sk", "ordered_date_key"],
}
UNIQUE = {
    "dim_date": ["date_key"],
    "dim_store": ["store_sk"],
    "dim_employee": ["employee_sk"],
    "dim_payment_method": ["payment_method_sk"],
    "dim_customer": ["customer_sk"],
    "dim_product": ["product_sk"],
    "fct_sales": ["sales_sk"],
    "fct_payments": ["payment_sk"],
    "fct_inventory_daily": ["inventory_sk"],
    "fct_order_lifecycle": ["lifecycle_sk"],
}
RELATIONSHIPS = [
    Relationship("fct_sales", "customer_sk", "dim_customer", "customer_sk"),
    Relationship("fct_sales", "product_sk", "dim_product", "product_sk"),
    Relationship("fct_sales", "store_sk", "dim_store", "store_sk"),
    Relationship("fct_sales", "employee_sk", "dim_employee", "employee_sk"),
    Relationship("fct_sales", "date_key", "dim_date", "date_key"),
    Relationship("fct_payments", "customer_sk", "dim_customer", "customer_sk"),
    Relationship("fct_payments", "store_sk", "dim_store", "store_sk"),
    Relationship("fct_payments", "payment_method_sk", "dim_payment_method", "payment_method_sk"),
    Relationship("fct_payments", "date_key", "dim_date", "date_key"),
    Relationship("fct_inventory_daily", "product_sk", "dim_product", "product_sk"),
    Relationship("fct_inventory_daily", "store_sk", "dim_store", "store_sk"),
    Relationship("fct_inventory_daily", "date_key", "dim_date", "date_key"),
    Relationship("fct_order_lifecycle", "customer_sk", "dim_customer", "customer_sk"),
    Relationship("fct_order_lifecycle", "store_sk", "dim_store", "store_sk"),
    Relationship("fct_order_lifecycle", "ordered_date_key", "dim_date", "date_key"),
]
RULES = ("fct_sales_no_negative_line_total", "fct_inventory_no_negative_quantity",
         "fct_order_lifecycle_ordered_before_delivered", "fct_payments_no_flagged_payments")


def _row(test: str, model: str, column: str | None, failures: Column) -> Column:
    return F.struct(F.lit(test).alias("test"), F.lit(model).alias("model"),
                    F.lit(column).cast("string").alias("column_name"),
                    failures.cast("bigint").alias("failures"))


def not_null_checks(marts: dict[str, DataFrame], spec=None) -> DataFrame:
    frames = []
    for model, cols in (spec or NOT_NULL).items():
        counts = marts[model].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        frames.append(counts.select(F.inline(F.array(*[_row("not_null", model, c, F.col(c)) for c in cols]))))
    return _union(frames)


def unique_checks(marts: dict[str, DataFrame], spec=None) -> DataFrame:
    frames = []
    for model, cols in (spec or UNIQUE).items():
        for c in cols:
            key = packed(c) if marts[model].schema[c].dataType.simpleString() == "string" else F.col(c)
            dup = (marts[model].where(F.col(c).isNotNull()).groupBy(key.alias("key")).count()
                   .where(F.col("count") > 1))
            frames.append(dup.agg(F.count(F.lit(1)).alias("n"))
                          .select(F.inline(F.array(_row("unique", model, c, F.col("n"))))))
    return _union(frames)


def relationship_checks(marts: dict[str, DataFrame], spec=None) -> DataFrame:
    """One pass per child table: its foreign-key columns are unpivoted to
    ``(column, value)`` pairs and anti-joined once against the parents' keys
    tagged with the same column name, then counted per column. The child is
    computed once, not once per foreign key."""
    by_model: dict[str, list[Relationship]] = {}
    for r in spec or RELATIONSHIPS:
        by_model.setdefault(r.model, []).append(r)
    frames = []
    for model, rels in by_model.items():
        pairs = (marts[model]
                 .select(F.inline(F.array(*[F.struct(F.lit(r.column).alias("_c"),
                                                      F.col(r.column).cast("string").alias("_v"))
                                            for r in rels])))
                 .where(F.col("_v").isNotNull())
                 .groupBy("_c", "_v").agg(F.count("*").alias("_n")))  # map-side: a few values hold most rows
        parents = _union([marts[r.to_model].select(F.lit(r.column).alias("_c"),
                                                   F.col(r.to_column).cast("string").alias("_v"))
                          for r in rels])
        orphans = pairs.join(parents, ["_c", "_v"], "left_anti")
        counts = orphans.agg(*[F.coalesce(F.sum(F.when(F.col("_c") == r.column, F.col("_n"))), F.lit(0)).alias(r.column) for r in rels])
        frames.append(counts.select(F.inline(F.array(
            *[_row("relationships", model, r.column, F.col(r.column)) for r in rels]))))
    return _union(frames)


def rule_violations(marts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Q-4 … Q-7 as the violating rows (a zero-row result passes)."""
    sales, inv = marts["fct_sales"], marts["fct_inventory_daily"]
    life, pay, flag = marts["fct_order_lifecycle"], marts["fct_payments"], marts["flagged_payments"]
    return {
        "fct_sales_no_negative_line_total": sales.where(F.col("line_total") < 0),
        "fct_inventory_no_negative_quantity": inv.where((F.col("quantity_in") < 0) | (F.col("quantity_out") < 0)),
        "fct_order_lifecycle_ordered_before_delivered":
            life.where(F.col("delivered_at").isNotNull() & (F.col("ordered_at") > F.col("delivered_at"))),
        # counting only: a semi join is enough and never multiplies rows
        "fct_payments_no_flagged_payments":
            pay.join(flag.select("payment_id"), "payment_id", "left_semi"),
    }


_RULE_MODEL = {
    "fct_sales_no_negative_line_total": "fct_sales",
    "fct_inventory_no_negative_quantity": "fct_inventory_daily",
    "fct_order_lifecycle_ordered_before_delivered": "fct_order_lifecycle",
    "fct_payments_no_flagged_payments": "fct_payments",
}


def rule_checks(marts: dict[str, DataFrame]) -> DataFrame:
    frames = []
    for name, rows in rule_violations(marts).items():
        frames.append(rows.agg(F.count(F.lit(1)).alias("n"))
                      .select(F.inline(F.array(_row(name, _RULE_MODEL[name], None, F.col("n"))))))
    return _union(frames)


# Row-level business rules that are one predicate on one table (Q-4 … Q-6).
_ROW_RULES = {
    "fct_sales": [("fct_sales_no_negative_line_total", lambda: F.col("line_total") < 0)],
    "fct_inventory_daily": [("fct_inventory_no_negative_quantity",
                             lambda: (F.col("quantity_in") < 0) | (F.col("quantity_out") < 0))],
    "fct_order_lifecycle": [("fct_order_lifecycle_ordered_before_delivered",
                             lambda: F.col("delivered_at").isNotNull()
                             & (F.col("ordered_at") > F.col("delivered_at")))],
}


def row_rules(model: str) -> list[tuple[str, Column]]:
    """The rules on single rows of a table: name and the predicate of a violation."""
    return [(name, hit()) for name, hit in _ROW_RULES.get(model, [])]


def leak_check(marts: dict[str, DataFrame]) -> DataFrame:
    """Q-7: clean payments that are quarantined too."""
    name = "fct_payments_no_flagged_payments"
    return rule_violations(marts)[name].agg(F.count(F.lit(1)).alias("n")).select(
        F.inline(F.array(_row(name, _RULE_MODEL[name], None, F.col("n")))))


def _table_pass(model: str, marts: dict[str, DataFrame], not_null: list[str], unique: list[str], rels: list[Relationship],
                rules: list) -> DataFrame:
    """All checks of one table from one pass over it.

    Every tested column gives a ``(column, value)`` pair, the first one carries
    the hits of the row rules. Pairs are counted map-side and after one shuffle:
    pairs without a value are NULLs, a value of a unique column met more than
    once is a repeated one, and the values of foreign keys meet the tagged
    parent keys, which lie by the same pairs."""
    columns = list(dict.fromkeys([*unique, *not_null, *[r.column for r in rels]]))
    place = {c: i for i, c in enumerate(columns)}
    hits = [f"_r{i}" for i in range(len(rules))]
    pairs = marts[model].select(F.inline(F.array(*[F.struct(
        F.lit(place[c]).alias("_c"), F.col(c).cast("string").alias("_v"),
        *[(F.coalesce(pred(), F.lit(False)) if place[c] == 0 else F.lit(False)).cast("int").alias(h)
          for h, (_, pred) in zip(hits, rules, strict=True)]) for c in columns])))
    counted = pairs.groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(h).alias(h) for h in hits])
    if rels:
        parents = _union([marts[r.to_model].select(F.lit(place[r.column]).alias("_c"), F.col(r.to_column).cast("string").alias("_v"))
                          for r in rels]).distinct().withColumn("_parent", F.lit(True))
        counted = counted.join(parents, ["_c", "_v"], "left")
    of = {c: F.col("_c") == i for c, i in place.items()}
    known = F.col("_v").isNotNull()
    rows = ([_row("not_null", model, c, F.coalesce(F.sum(F.when(of[c] & ~known, F.col("_n"))), F.lit(0))) for c in not_null]
            + [_row("unique", model, c, F.count_if(of[c] & known & (F.col("_n") > 1))) for c in unique]
            + [_row("relationships", model, r.column, F.coalesce(F.sum(F.when(of[r.column] & known & F.col("_parent").isNull(), F.col("_n"))), F.lit(0)))
               for r in rels]
            + [_row(name, model, None, F.coalesce(F.sum(h), F.lit(0))) for h, (name, _) in zip(hits, rules, strict=True)])
    return counted.agg(*[r.alias(f"row{i}") for i, r in enumerate(rows)]).select(F.inline(F.array(*[F.col(f"row{i}") for i in range(len(rows))])))


def run_suite(marts: dict[str, DataFrame]) -> DataFrame:
    """Q-8: all 58 checks as one result table.

    Each table is computed once for its not-null, unique, relationship and
    row-rule checks; parent keys and the leak check read their tables besides.
    """
    frames = [_table_pass(model, marts, cols, UNIQUE.get(model, []), [r for r in RELATIONSHIPS if r.model == model], _ROW_RULES.get(model, []))
              for model, cols in NOT_NULL.items()]
    frames.append(leak_check(marts))
    return _union(frames)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def payment_conservation(payments: DataFrame, fct_payments: DataFrame, flagged: DataFrame) -> DataFrame:
    """Every payment is clean, flagged, or — through SQL NULL logic (NULL
    amount, or negative with a NULL type) — in neither. One aggregate over the
    three tables tagged and stacked; ``conserved`` says the counts add up."""
    amount, ptype = F.col("amount_paid"), F.col("payment_type")
    stacked = (payments.select(F.lit("p").alias("_t"),
                               (amount.isNull() | ((amount < 0) & ptype.isNull())).alias("_u"))
               .unionByName(fct_payments.select(F.lit("c").alias("_t"), F.lit(False).alias("_u")))
               .unionByName(flagged.select(F.lit("f").alias("_t"), F.lit(False).alias("_u"))))
    t = F.col("_t")
    counts = stacked.agg(F.count_if(t == "p").alias("total_payments"), F.count_if(t == "c").alias("clean"),
                         F.count_if(t == "f").alias("flagged"), F.count_if(F.col("_u")).alias("unclassified"))
    return counts.select("*", (F.col("total_payments") == F.col("clean") + F.col("flagged")
                               + F.col("unclassified")).alias("conserved"))
