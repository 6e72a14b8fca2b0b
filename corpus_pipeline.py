"""Corpus pipeline: quality, near duplicates, benchmark, secrets, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps,
with the columns of documents; the last one returns their tokens. Stages are
written as Parquet and read again in between.

A stage decides on each row by itself: rows are numbered by their file and their
place in it (:func:`_numbered`), never looked up by doc_id. So rows with a null
doc_id are judged like others, and rows that share a doc_id each by their own
text. Null and empty texts stay in every stage, an empty table gives an empty
one, and columns that documents lack here pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm import decontaminate, quality_model, secret_scan, sentence_pieces, shingle_join
from starmart.llm.common import materialize, read_table
from starmart.llm.queries import BENCHMARK_WORDS, PIECES, tokenizer_path

#: Near duplicates share 0.8 or more of their 5-word shingles.
NEAR_WORDS, NEAR_SHARE = 5, (80, 100)
#: Bits of a row's place in its file; the file's number stands before them.
ROW_BITS = 40


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column, and its name, that numbers each row, the same in
    every read: its file's number, then its place in the file. Rows that aren't
    just read from Parquet files are written first."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = materialize(docs, "stage-rows")
    row = "row"
    while row in docs.columns:
        row = f"_{row}"
    at, file, number = docs.metadataColumn("_metadata"), f"{row}_file", f"{row}_number"
    placed = docs.select("*", at["file_path"].alias(file), at["row_index"].alias(row))
    files = placed.select(file).distinct().withColumn(number, F.row_number().over(Window.orderBy(file)) - 1)
    files = materialize(files, "stage-files")  # a row for each file of the input, as Spark's own listing
    whole = (F.shiftleft(F.col(number).cast("long"), ROW_BITS) + F.col(row)).alias(row)
    return placed.join(F.broadcast(files), file).select(*docs.columns, whole), row


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity isn't over their language's threshold."""
    rows, row = _numbered(docs)
    judged = quality_model.classify(rows, read_table(spark, sf_dir, "labels"), row)
    return rows.join(judged.where("NOT accepted").select(row), row, "left_anti").select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group (a null one last; of
    equal ids the first row). Documents without words are no copies of others."""
    rows, row = _numbered(docs)
    found = shingle_join.similar_components(rows.select(F.col(row).alias("doc_id"), "text"), NEAR_WORDS, *NEAR_SHARE)
    ids = rows.select(F.col(row).alias("member"), F.col("doc_id").cast("long").alias("doc_id"))
    order = F.struct(F.col("ids.doc_id").isNull().alias("unknown"), F.col("ids.doc_id").alias("id"), F.col("member").alias(row))
    first = (found.alias("found").join(ids.alias("ids"), F.col("found.doc_id") == F.col("member"))
             .groupBy("component_id").agg(F.min(order).alias("first")).select(f"first.{row}"))
    return rows.join(first, row, "left_semi").select(docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    rows, row = _numbered(docs)
    found = decontaminate.contamination(rows.select(F.col(row).alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"), BENCHMARK_WORDS)
    return rows.join(found.where("contaminated").select(F.col("doc_id").alias(row)), row, "left_anti").select(docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    ratio = secret_scan.train_ratio(docs)
    clean = secret_scan.redact(docs, ratio)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars and the token ids of every document."""
    return sentence_pieces.encode_documents(docs, tokenizer_path(PIECES)).withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("secret scans", secret_stage),
    ("sentencepiece encoding", token_stage),
]

#: Perplexities, Markov scores and merges aren't expressible; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
