"""What a task of the alignment holds doesn't grow with the number of packs."""

import glob

import pyarrow.parquet as pq

from starmart.llm import token_alignment
from starmart.llm.common import LARGE_ROWS, discard, materialize
from starmart.llm.queries import BYTE_TOKENS, PIECES, tokenizer_path
from starmart.session import local_path


def test_row_groups_of_large_rows_are_small(spark):
    rows = spark.range(0, 60, 1, 1).selectExpr("id", "transform(sequence(1, 100000), i -> hash(i, id)) AS v")
    made = materialize(rows, "large-rows", LARGE_ROWS)
    try:
        files = [pq.ParquetFile(f) for f in glob.glob(f"{local_path(made.scratch)}/*.parquet")]
        groups = [f.metadata.row_group(i).num_rows for f in files for i in range(f.metadata.num_row_groups)]
        assert sum(groups) == 60 and max(groups) <= 8, groups  # before, one group of all rows
        assert made.count() == 60
    finally:
        discard(made)


def test_packs_meet_their_pairs_without_being_gathered(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "PACK_BYTES", 200)
    rows = [(i, f"Document {i} of the same words and number {i % 3}.") for i in range(40)] + [(None, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = token_alignment.alignment_digests(docs, tokenizer_path(BYTE_TOKENS), tokenizer_path(PIECES))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "FlatMapCoGroupsInArrow" in plan, plan  # before, up to 128 packs of a task at once
    got = found.collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)


def test_documents_come_in_small_batches(spark, monkeypatch):
    seen = []

    def kept(df, name, options=None, step=token_alignment.materialize):
        seen.append((name, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), bool(options)))
        return step(df, name, options)

    monkeypatch.setattr(token_alignment, "materialize", kept)
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    token_alignment.alignment_digests(docs, tokenizer_path(BYTE_TOKENS), tokenizer_path(PIECES)).collect()
    assert ("alignment-packs", "512", True) in seen  # before, 10000 documents of any length
