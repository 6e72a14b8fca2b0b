import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmart.operators.scd2 import current_rows, latest_per_key, scd2_backfill, scd2_snapshot

from conftest import rows

SCHEMA = "k bigint, attr string, updated_at timestamp_ntz"
T = [dt.datetime(2024, 1, d) for d in range(1, 11)]
TRACKED = ["k", "attr", "updated_at"]


def src(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def snap(history, source):
    return scd2_snapshot(history, source, "k", tracked=TRACKED)


def test_first_run_opens_every_key(spark):
    h = snap(None, src(spark, [(1, "a", T[0]), (2, "b", T[0])]))
    r = rows(h, ["k"])
    assert [x["valid_to"] for x in r] == [None, None]
    assert [x["valid_from"] for x in r] == [T[0], T[0]]


def test_change_closes_and_opens(spark):
    h1 = snap(None, src(spark, [(1, "a", T[0]), (2, "b", T[0])]))
    h2 = snap(h1, src(spark, [(1, "a2", T[2]), (2, "b", T[0])]))
    r = rows(h2, ["k", "valid_from"])
    assert [(x["k"], x["attr"], x["valid_from"], x["valid_to"]) for x in r] == [
        (1, "a", T[0], T[2]), (1, "a2", T[2], None), (2, "b", T[0], None)]


def test_rerun_adds_nothing(spark):
    s = src(spark, [(1, "a", T[0]), (2, "b", T[1])])
    h1 = snap(None, s)
    h2 = snap(h1, s)
    assert sorted(map(tuple, h1.collect())) == sorted(map(tuple, h2.collect()))


def test_hard_delete_stays_open(spark):
    h1 = snap(None, src(spark, [(1, "a", T[0]), (2, "b", T[0])]))
    h2 = snap(h1, src(spark, [(1, "a", T[0])]))
    assert rows(current_rows(h2).select("k"), ["k"]) == [{"k": 1}, {"k": 2}]


def test_attribute_change_without_newer_timestamp_is_missed(spark):
    h1 = snap(None, src(spark, [(1, "a", T[3])]))
    h2 = snap(h1, src(spark, [(1, "changed", T[3])]))
    assert rows(h2.select("attr"), ["attr"]) == [{"attr": "a"}]


def test_null_updated_at_uses_presence_flag(spark):
    h1 = snap(None, src(spark, [(1, "a", None)]))
    h2 = snap(h1, src(spark, [(1, "a", None)]))
    h3 = snap(h2, src(spark, [(1, "a", None)]))
    assert h3.count() == 1  # no copy per rerun


def test_latest_per_key_hot_key(spark):
    data = [(1, f"v{i}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(3000)]
    data += [(2, "x", T[0])]
    df = spark.createDataFrame(data, SCHEMA).repartition(8)
    r = rows(latest_per_key(df, "k", ["updated_at"]), ["k"])
    assert [(x["k"], x["attr"]) for x in r] == [(1, "v2999"), (2, "x")]


changes_strategy = st.lists(
    st.tuples(st.integers(0, 4), st.sampled_from(["a", "b", "c"]), st.integers(0, 9), st.integers(0, 3)),
    min_size=1, max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(changes_strategy)
def test_backfill_equals_daily_runs(spark, changes):
    """Replaying the log in one pass equals one snapshot run per batch."""
    data = [(k, a, T[t], b, i) for i, (k, a, t, b) in enumerate(changes)]
    df = spark.createDataFrame(data, SCHEMA + ", batch int, seq int")
    back = scd2_backfill(df, "k", "batch", tracked=TRACKED, arrival="seq")

    history = None
    state = None
    for b in sorted({x[3] for x in data}):
        # the source at batch b: latest change per key up to b (ties: later arrival)
        upto = [x for x in data if x[3] <= b]
        latest = {}
        for x in upto:
            cur = latest.get(x[0])
            if cur is None or (x[2], x[4]) > (cur[2], cur[4]):
                latest[x[0]] = x
        state = src(spark, [(x[0], x[1], x[2]) for x in latest.values()])
        history = snap(history, state)
        history = spark.createDataFrame(history.collect(), history.schema)  # cut lineage

    def norm(df):
        return sorted(tuple(r) for r in df.select("k", "attr", "updated_at", "scd_id", "valid_from",
                                                   "valid_to").collect())
    assert norm(back) == norm(history)
    # invariants: one open row per key; intervals never overlap
    assert current_rows(history).groupBy("k").count().where(F.col("count") > 1).count() == 0
    for k in {x[0] for x in data}:
        iv = sorted((r.valid_from, r.valid_to) for r in history.where(F.col("k") == k).collect())
        for (a_from, a_to), (b_from, _) in zip(iv, iv[1:]):
            assert a_to is not None and a_to <= b_from


def test_scd2_store_appends_only_changes(spark, tmp_dir):
    import os
    from starmart.operators.scd2_store import Scd2Store
    store = Scd2Store(spark, os.path.join(tmp_dir, "snap"))
    s1 = src(spark, [(1, "a", T[0]), (2, "b", T[0])])
    store.run(s1, "k", TRACKED)
    store.run(s1, "k", TRACKED)                       # rerun: nothing closes
    assert store.closed_rows() is None and store.open_rows().count() == 2
    h = store.run(src(spark, [(1, "a2", T[3]), (2, "b", T[0])]), "k", TRACKED)
    assert store.closed_rows().count() == 1 and h.count() == 3
    assert rows(store.open_rows().select("k", "attr"), ["k"]) == [{"k": 1, "attr": "a2"}, {"k": 2, "attr": "b"}]


def test_scd2_store_prunes_closed_rows_by_month(spark, tmp_dir):
    import datetime as dt
    import os
    from starmart.operators.scd2_store import MONTH, Scd2Store
    at = [dt.datetime(2023, 12, 31), dt.datetime(2024, 1, 15), dt.datetime(2024, 2, 1)]
    changes = spark.createDataFrame([(1, v, t, t.date()) for v, t in zip("abc", at)] + [(2, "x", at[0], at[0].date())],
                                    f"{src(spark, []).schema.simpleString()[7:-1].replace(':', ' ')}, day date")
    store = Scd2Store(spark, os.path.join(tmp_dir, "snap"))
    assert store.closed_rows(202401, 202401) is None
    store.load(scd2_backfill(changes, "k", "day", tracked=TRACKED))
    assert MONTH not in store.history().columns and store.history().count() == 4
    january = store.closed_rows(202401, 202401)
    assert rows(january.select("k", "attr")) == [{"k": 1, "attr": "a"}]
    assert MONTH in january._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    # a batch without key 2: it stays open
    store.run(src(spark, [(1, "d", dt.datetime(2024, 3, 1))]), "k", TRACKED)
    assert rows(store.open_rows().select("k", "attr"), ["k"]) == [{"k": 1, "attr": "d"}, {"k": 2, "attr": "x"}]
    assert store.closed_rows(first_month=202402).count() == 2 and store.closed_rows().count() == 3
    import pytest
    with pytest.raises(ValueError):
        store.load(store.history())
