"""What a daily run leaves on the disk."""

import glob
import os

from starmart.plans.pipeline import DailyRun
from starmart.session import _FREE_SHUFFLES, ensure_checkpoint_dir, freed_shuffles, local_path
from starmart.sources.landing import write_pages


def _parsed(spark) -> set[str]:
    return set(glob.glob(f"{local_path(ensure_checkpoint_dir(spark))}/starmart-scratch/pages-*"))


def test_load_leaves_no_parsed_pages_and_lands_compressed(spark, tmp_dir):
    rows = spark.range(500).selectExpr("cast(id AS string) AS id", "concat('name ', id) AS storeName", "'2024-01-01T00:00:00Z' AS updatedAt")
    write_pages(rows, f"{tmp_dir}/landing/stores")
    landed = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/landing/stores/part-*"))
    text = spark.read.text(f"{tmp_dir}/landing/stores").selectExpr("sum(length(value)) AS n").first().n
    assert landed < text / 4

    before = _parsed(spark)
    run = DailyRun(spark, f"{tmp_dir}/wh", buckets=2)
    run.load(f"{tmp_dir}/landing", run_id=1, entities=["stores"])
    assert _parsed(spark) == before
    got = {(r.id, r.store_name) for r in run.raw("stores").read().collect()}
    assert got == {(str(i), f"name {i}") for i in range(500)}


def test_shuffles_are_freed_only_inside(spark):
    before = spark.conf.get(_FREE_SHUFFLES, None)
    with freed_shuffles(spark):
        assert spark.conf.get(_FREE_SHUFFLES) == "true"
    assert spark.conf.get(_FREE_SHUFFLES, None) == before
