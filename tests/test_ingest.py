"""Landing, staging casts, versioned tables and the streaming merge."""

import json
import os

import pytest
from pyspark.sql import functions as F

from starmart.operators import staging
from starmart.plans.versions import VersionedTable
from starmart.sources.landing import normalize_names, read_pages, snake_case
from starmart.streaming.stream_merge import run_stream_merge
from starmart.plans.changelog import EVENT_ROW, _typed_events

from conftest import rows


def write_lines(path, name, docs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")


def test_snake_case():
    assert [snake_case(x) for x in ("updatedAt", "id", "HTTPCode", "paymentMethodId", "already_snake")] == [
        "updated_at", "id", "http_code", "payment_method_id", "already_snake"]


def test_read_pages_drift_nested_missing(spark, tmp_dir):
    write_lines(tmp_dir, "p1.json", [
        {"data": [{"id": "1", "isDeleted": True, "price": 12.50, "tags": ["a"], "updatedAt": "2024-01-01T00:00:00Z"}],
         "meta": {"has_more": True, "cursor": "c1"}},
        {"meta": {"has_more": True, "cursor": "c2"}},                                  # page without data
    ])
    write_lines(tmp_dir, "p2.json", [
        {"data": [{"id": "2", "newField": "late", "address": {"city": "Kano"}}]}])     # no meta: last page
    raw = normalize_names(read_pages(spark, tmp_dir))
    r = {x["id"]: x for x in rows(raw, ["id"])}
    assert set(raw.columns) >= {"id", "is_deleted", "price", "tags", "updated_at", "new_field", "address"}
    assert r["1"]["is_deleted"] == "true" and r["1"]["price"] == "12.5" and r["1"]["tags"] == '["a"]'
    assert r["1"]["new_field"] is None and r["2"]["new_field"] == "late"
    assert json.loads(r["2"]["address"]) == {"city": "Kano"}


def test_stage_casts_and_bad_rows(spark):
    raw = spark.createDataFrame([
        ("A0EEBC99-9C0B-4EF8-BB6D-6BB9BD380A11", "b0eebc999c0b4ef8bb6d6bb9bd380a11", None, None, "shipped",
         None, "0", "12.34567", "2024-01-01T05:06:05.678+01:00", None, None, None, None, "2024-01-01", "2024-01-02"),
    ], ", ".join(f"{c} string" for c in ["id", "customer_id", "store_id", "employee_id", "status", "discount_code",
                                          "discount_amount", "total_amount", "ordered_at", "paid_at", "shipped_at",
                                          "delivered_at", "cancelled_at", "created_at", "updated_at"]))
    r = staging.stage("orders", raw, check_scale=False).first()
    assert r.order_id == "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"
    assert r.customer_id == "b0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"
    assert str(r.total_amount) == "12.3457"       # numeric(18,4) rounds
    assert r.ordered_at.hour == 5                 # offset dropped
    with pytest.raises(Exception, match="decimals"):
        staging.stage("orders", raw).collect()  # the default: no decimal is lost unnoticed
    bad = raw.withColumn("customer_id", F.lit("broken"))
    with pytest.raises(Exception, match="uuid"):
        staging.stage("orders", bad).collect()
    assert staging.bad_rows("orders", bad).first().failed_columns == ["customer_id"]


def test_missing_raw_column_is_null(spark):
    raw = spark.createDataFrame([("a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11", "Cash")], "id string, name string")
    r = staging.stage("payment_methods", raw).first()
    assert r.payment_method_name == "Cash" and r.is_digital is None


def test_versioned_table_commits(spark, tmp_dir):
    t = VersionedTable(spark, os.path.join(tmp_dir, "tbl"))
    assert t.read() is None
    v1 = t.write(spark.range(3), batch_id=0)
    v2 = t.write(spark.range(5), commit=False)      # crashed before commit: invisible
    assert (v1, v2) == (1, 2) and t.current_version() == 1 and t.read().count() == 3
    assert t.last_batch_id() == 0


def day_page(landing, day, users=3):
    write_lines(os.path.join(landing, f"day={day}"), "page.json", [{"data": [
        {"id": str(10 * day + i), "userId": str(i % users), "eventType": f"t{day}", "value": "1.00",
         "props": "{}", "updatedAt": f"2024-01-0{day + 1}T00:00:0{i}Z"} for i in range(5)]}])


def run_days(spark, tmp_dir, checkpoint="ckpt"):
    return run_stream_merge(spark, os.path.join(tmp_dir, "landing", "*/"), EVENT_ROW, os.path.join(tmp_dir, "table"), os.path.join(tmp_dir, checkpoint),
                            key="user_id", order=["updated_at", "event_id"], prepare=_typed_events, max_files_per_trigger=1)


def latest(table):
    return {r.user_id: r.event_id for r in table.read().collect()}


def test_stream_writes_changed_keys_only_and_restarts(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    for day in range(3):
        day_page(landing, day)
    t = run_days(spark, tmp_dir)
    assert latest(t) == {0: 23, 1: 24, 2: 22}
    first = t.batches()
    assert len(first) == 3  # one page file a micro-batch
    # nothing new landed: nothing is written
    assert run_days(spark, tmp_dir).batches() == first
    # after a restart the state knows the keys: a late page changes none of them
    write_lines(os.path.join(landing, "day=late"), "page.json", [{"data": [
        {"id": "90", "userId": "0", "eventType": "late", "value": "2.00", "props": "{}", "updatedAt": "2024-01-01T00:00:00Z"},
        {"id": "91", "userId": "9", "eventType": "new", "value": "2.00", "props": "{}", "updatedAt": "2024-01-01T00:00:00Z"}]}])
    t = run_days(spark, tmp_dir)
    (late,) = set(t.batches()) - set(first)
    written = {r.user_id: r.event_id for r in spark.read.parquet(f"{t.path}/{late}").collect()}
    assert written == {0: 23, 9: 91}  # the touched keys, each with its latest row
    assert latest(t) == {0: 23, 1: 24, 2: 22, 9: 91}
    # a replayed batch replaces its folder; a new checkpoint starts over; both change nothing
    t.write_batch(spark.read.parquet(f"{t.path}/{late}"), 0)
    assert latest(run_days(spark, tmp_dir, "other")) == {0: 23, 1: 24, 2: 22, 9: 91}


def test_stream_state_is_in_rocksdb(spark, tmp_dir):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    day_page(os.path.join(tmp_dir, "landing"), 0)
    run_days(spark, tmp_dir)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    state = [f for _, _, files in os.walk(os.path.join(tmp_dir, "ckpt", "state")) for f in files]
    assert any(f.endswith(".zip") or f.endswith(".changelog") for f in state)
