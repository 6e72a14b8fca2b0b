"""Tables replaced by days, distinct counts that unite, reports and inventory by days."""

import datetime as dt
import decimal
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmart.operators import distinct_states
from starmart.plans import daily_reports, inventory
from starmart.plans.daily import DayTable

D = decimal.Decimal
day = lambda m, d: dt.date(2024, m, d)


def files(path):
    return {os.path.relpath(os.path.join(r, f), path) for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def table(spark, tmp_dir, period="month"):
    rows = spark.createDataFrame([(1, day(1, 1)), (2, day(1, 2)), (3, day(2, 1)), (4, day(3, 1)), (5, None)], "v int, d date")
    t = DayTable(spark, f"{tmp_dir}/days", rows.schema, "d", period)
    assert t.read().collect() == []  # not written yet
    t.replace(rows)
    return t


@pytest.mark.parametrize("period", ["day", "month", "year"])
def test_days_are_replaced_alone(spark, tmp_dir, period):
    t = table(spark, tmp_dir, period)
    assert {tuple(r) for r in t.read([day(1, 2), None]).collect()} == {(2, day(1, 2)), (5, None)}
    t.replace(spark.createDataFrame([(20, day(1, 2)), (50, None)], t.schema), {day(1, 2), None, day(3, 1)})
    assert {tuple(r) for r in t.read().collect()} == {(1, day(1, 1)), (20, day(1, 2)), (3, day(2, 1)), (50, None)}
    t.replace(t.read().limit(0), {None})
    assert t.read([None]).collect() == [] and t.read().count() == 3
    t.replace(t.read().limit(0), set())  # no days, nothing to do
    assert t.read().count() == 3


def test_files_of_other_months_stay(spark, tmp_dir):
    t = table(spark, tmp_dir)
    before = files(t.path)
    t.replace(spark.createDataFrame([(20, day(1, 2))], t.schema), {day(1, 2)})
    gone, new = before - files(t.path), files(t.path) - before
    assert gone and new and all(f.startswith("_from=2024-01-01/") for f in gone | new)
    plan = t.read([day(2, 1)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-02-01" in plan


def counted(spark, rows, days_of):
    df = spark.createDataFrame(rows, "g string, d int, id long")
    by_day = distinct_states.states(df, ["g", "d"], "id")
    got = {r.g: r.n for r in distinct_states.merged(by_day.where(F.col("d").isin(days_of)), ["g"], "n").collect()}
    want = {}
    for g, d, i in rows:
        if i is not None and d in days_of:
            want.setdefault(g, set()).add(i)
    return got, {g: len(s) for g, s in want.items()}


IDS = st.one_of(st.none(), st.integers(-5, 5), st.integers(-2**63, 2**63 - 1), st.sampled_from([0, 1, 32768, 32769, -32768, -32767, 65536]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", None, ""]), st.integers(0, 2), IDS), min_size=1, max_size=30))
def test_union_of_states_is_exact(spark, rows):
    got, want = counted(spark, rows, [0, 2])
    assert got == want


def test_full_and_thin_buckets_unite(spark):
    r = random.Random(4)
    rows = [("x", 0, i) for i in range(1, 5000)] + [("x", 1, i) for i in range(4000, 4500)]  # full on day 0, thin on day 1
    rows += [("y", d, r.randrange(10**12)) for d in (0, 1) for _ in range(500)] + [("y", 0, None)] * 3
    df = spark.createDataFrame(rows, "g string, d int, id long")
    forms = {(s.g, s.d, s.bitmap is not None) for s in distinct_states.states(df, ["g", "d"], "id").collect()}
    assert ("x", 0, True) in forms and ("x", 1, False) in forms and ("y", 0, True) not in forms
    got, want = counted(spark, rows, [0, 1])
    assert got == want
    with pytest.raises(TypeError):
        distinct_states.states(df.withColumn("id", F.col("id").cast("string")), ["g"], "id")


FACT = "day date, segment string, order_id long, customer_id long, total_amount decimal(18,2)"


def brute(rows):
    out = {}
    for _, seg, o, c, a in rows:
        s = out.setdefault(seg, [set(), set(), D(0), 0])
        s[0] |= {o} - {None}
        s[1] |= {c} - {None}
        s[2], s[3] = s[2] + (a or 0), s[3] + (a is not None)
    return {k: (len(o), len(c), t if n else None, n) for k, (o, c, t, n) in out.items()}


def report(states):
    return {r.segment: (r.n_order_id, r.n_customer_id, r.sum_total_amount, r.count_total_amount) for r in states.result().collect()}


def test_a_changed_day_is_aggregated_alone(spark, tmp_dir):
    r = random.Random(7)
    days = [day(1, 5), day(1, 6), day(2, 7), day(3, 8), None]
    rows = [(r.choice(days), r.choice(["A", "B", None]), r.randrange(80), r.choice([None, *range(9)]), r.choice([None, D("1.25"), D("-3.10")])) for _ in range(400)]
    rows += [(day(3, 8), "only null", 1, None, None)]
    fact = DayTable(spark, f"{tmp_dir}/fact", spark.createDataFrame([], FACT).schema, "day")
    fact.replace(spark.createDataFrame(rows, FACT))
    states = daily_reports.DailyStates(fact, f"{tmp_dir}/states", ["segment"], ["order_id", "customer_id"], ["total_amount"])
    states.refresh()
    assert report(states) == brute(rows)
    before = files(f"{tmp_dir}/states")
    changed = [(day(2, 7), "C", 1000, 7, D("5.00"))]
    assert daily_reports.apply_days(states, spark.createDataFrame(changed, FACT)) == {day(2, 7)}
    assert report(states) == brute([x for x in rows if x[0] != day(2, 7)] + changed)
    touched = before ^ files(f"{tmp_dir}/states")
    assert touched and all("_from=2024-02-01/" in f for f in touched)
    plan = states.result()._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_reports_over_empty_facts(spark, tmp_dir):
    fact = DayTable(spark, f"{tmp_dir}/fact", spark.createDataFrame([], FACT).schema, "day")
    fact.replace(spark.createDataFrame([], FACT))
    states = daily_reports.DailyStates(fact, f"{tmp_dir}/states", ["segment"], ["order_id"], ["total_amount"])
    states.refresh()
    assert states.result().collect() == []


MOVES = ("movement_id string, product_id long, store_id long, movement_type string, quantity int, moved_at timestamp_ntz, "
         "updated_at timestamp_ntz")


def at(m, d, h=0):
    return dt.datetime(2024, m, d, h)


@pytest.fixture()
def dims(spark):
    dates = spark.createDataFrame([(day(m, d),) for m in (1, 2, 3) for d in range(1, 29)], "date_key date")
    products = spark.createDataFrame([(f"p{i}", i, True) for i in range(3)], "product_sk string, product_id long, is_current boolean")
    return dates, products, spark.createDataFrame([("s1", 1)], "store_sk string, store_id long")


def test_late_and_moved_movements_rewrite_their_days(spark, tmp_dir, dims):
    first = [(f"m{i}", i % 3, 1, ["in", "out"][i % 2], i, at(1 + i % 3, 1 + i % 5), at(4, 1)) for i in range(40)]
    first += [("none", 1, 1, "in", 5, None, None), ("after", 1, 1, "in", 5, at(9, 1), at(9, 1))]
    schema = spark.createDataFrame([], MOVES).schema
    t = inventory.DailyInventory(spark, f"{tmp_dir}/inv", schema, *dims)
    t.apply(spark.createDataFrame(first, MOVES))
    before = files(t.fact.path)
    batch = [("new", 2, 1, "in", 9, at(2, 3), at(5, 1)),         # late
             ("m4", 1, 1, "in", 77, at(2, 9), at(5, 1)),          # was on 2 February 5, moves to the 9th
             ("m1", 1, 1, "out", 99, at(2, 2), at(3, 1))]         # older than the stored row: no change
    days = t.apply(spark.createDataFrame(batch, MOVES))
    assert days == {day(2, 3), day(2, 9), day(2, 5), day(2, 2)}
    touched = before ^ files(t.fact.path)
    assert touched and all(f.startswith("_from=2024-02-01/") for f in touched)
    rows = {x[0]: x for x in first} | {x[0]: x for x in batch if x[0] != "m1"}
    full = inventory.DailyInventory(spark, f"{tmp_dir}/full", schema, *dims)
    full.apply(spark.createDataFrame(list(rows.values()), MOVES))
    key = lambda r: str(tuple(r))
    assert sorted(t.read().collect(), key=key) == sorted(full.read().collect(), key=key)
    t.apply(spark.createDataFrame(batch, MOVES))  # again: nothing changes
    assert sorted(t.read().collect(), key=key) == sorted(full.read().collect(), key=key)


def test_new_product_version_rewrites_the_products_days(spark, tmp_dir, dims):
    moves = spark.createDataFrame([("a", 1, 1, "in", 2, at(1, 1), at(1, 1)), ("b", 2, 1, "in", 2, at(2, 1), at(2, 1))], MOVES)
    t = inventory.DailyInventory(spark, f"{tmp_dir}/inv", moves.schema, *dims)
    t.apply(moves)
    t.dims = (dims[0], dims[1].withColumn("product_sk", F.concat("product_sk", F.lit("-v2"))), dims[2])
    assert t.apply(moves.limit(0), changed_products=spark.createDataFrame([(1,)], "product_id long")) == {day(1, 1)}
    assert {r.product_sk for r in t.read().collect()} == {"p1-v2", "p2"}


def test_movements_without_an_id_fail(spark, tmp_dir, dims):
    moves = spark.createDataFrame([(None, 1, 1, "in", 2, at(1, 1), at(1, 1))], MOVES)
    with pytest.raises(ValueError):
        inventory.DailyInventory(spark, f"{tmp_dir}/inv", moves.schema, *dims).apply(moves)


def test_new_movements_are_added_and_only_repeated_ids_are_grouped(spark, tmp_dir, dims, monkeypatch):
    first = [(f"m{i}", 1 + i % 2, 1, "in", i, at(1, 1 + i % 5), at(1, 1)) for i in range(20)]
    more = [(f"n{i}", 1, 1, "out", i, at(1, 1 + i % 5), at(1, 1)) for i in range(20)]
    fixed = [("m3", 2, 1, "in", 50, at(2, 1), at(5, 1)), ("n4", 1, 1, "in", 60, at(1, 3), at(5, 1)), ("n4", 1, 1, "in", 70, at(2, 2), at(6, 1)), ("o", 1, 1, "in", 1, at(3, 1), None)]
    found = []
    for bar in (inventory.BROADCAST_HASHES, 1):  # repeated ids told apart, or all rows grouped
        monkeypatch.setattr(inventory, "BROADCAST_HASHES", bar)
        t = inventory.DailyInventory(spark, f"{tmp_dir}/inv{bar}", spark.createDataFrame(first, MOVES).schema, *dims)
        t.apply(spark.createDataFrame(first, MOVES))
        before = files(t.movements.path)
        assert t.apply(spark.createDataFrame(more, MOVES)) == {day(1, d) for d in range(1, 6)}
        assert before < files(t.movements.path)  # nothing stored was written again
        assert t.apply(spark.createDataFrame(fixed, MOVES)) == {day(2, 1), day(1, 4), day(1, 3), day(2, 2), day(1, 5), day(3, 1)}
        assert "inventory_sk" not in t.fact.schema.names  # made when read
        assert t.movements.read().count() == 41
        found.append(sorted(map(str, t.read().collect())))
    rows = {x[0]: x for x in first + more + fixed}
    full = inventory.DailyInventory(spark, f"{tmp_dir}/full", t.movements.schema, *dims)
    full.apply(spark.createDataFrame(list(rows.values()), MOVES))
    assert found[0] == found[1] == sorted(map(str, full.read().collect()))
