"""Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases (LZ78: the shortest string not yet in
the text's own dictionary), the phrase set is hashed, and a one-permutation
minimum-hash signature of the set is its fingerprint: ``BINS`` bins, the least
hash of each, 16 bits kept, ``-`` marking an empty bin. The likeness of two
fingerprints is the share of equal bins among those filled in either, an
estimate of the Jaccard similarity of the phrase sets, which is high where one
text compresses well given the other.

Defined results: null and empty texts have the all-empty fingerprint, which is
like (1.0) another empty one and unlike (0.0) any other; equal texts have equal
fingerprints; rows with a null doc_id come last in the order of neighbours;
repeated rows count as
one document in that order and are returned each, and rows that share a doc_id
but not the text are neighbours in the order of a hash of their texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import in_arrow, materialize

BINS = 64
EMPTY = np.uint32(0xFFFFFFFF)


def phrases(text: str) -> set[str]:
    """The phrases of a text; one that is still open at its end is known already."""
    seen: set[str] = set()
    add, w = seen.add, ""
    for c in text:
        w += c
        if w not in seen:
            add(w)
            w = ""
    return seen


def signature(found: set[str]) -> np.ndarray:
    """Least hash of each bin; EMPTY where no phrase falls into the bin."""
    bins = np.full(BINS, EMPTY, np.uint32)
    if found:
        h = np.fromiter(map(xxhash.xxh32_intdigest, found), np.uint32, len(found))
        np.minimum.at(bins, h % np.uint32(BINS), h // np.uint32(BINS))
    return bins


def render(bins: np.ndarray) -> str:
    """Four hex digits a bin; ``----`` for an empty one."""
    raw = (bins & np.uint32(0xFFFF)).astype(">u2").tobytes().hex()
    return "".join("----" if empty else raw[4 * i:4 * i + 4] for i, empty in enumerate((bins == EMPTY).tolist()))


def likeness(a: str, b: str) -> float:
    x, y = ([s[i:i + 4] for i in range(0, 4 * BINS, 4)] for s in (a, b))
    either = sum(p != "----" or q != "----" for p, q in zip(x, y, strict=True))
    return sum(p == q != "----" for p, q in zip(x, y, strict=True)) / either if either else 1.0


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``doc_id`` and the fingerprint of each text."""

    def run(batches):
        for batch in batches:
            made = [render(signature(phrases(x or ""))) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=["doc_id", out])

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text)), run, f"doc_id long, {out} string")


def successors(docs: DataFrame) -> DataFrame:
    """Each distinct document's key, its length, and the key and length of the
    document before it in descending order of doc_id (of the last, for the first).

    Only ids travel. They are dealt out by range, numbered within their range,
    and the ranges' sizes (one row each) are summed up, so that the numbers run
    on and no task sees more than its range.
    """
    keys = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64("text").alias("text_key"),
                        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))
            .distinct()
            .repartitionByRange(F.col("doc_id").desc_nulls_last(), F.col("text_key"))
            .withColumn("part", F.spark_partition_id()))
    keys = materialize(keys, "lz-keys")
    sizes = keys.groupBy("part").agg(F.count("*").alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").desc_nulls_last(), "text_key")
    at = (F.row_number().over(inside) + F.col("before") - 1).cast("long")
    numbered = materialize(
        keys.join(F.broadcast(before), "part")  # a row for each range partition
        .select("doc_id", "text_key", "n_chars", at.alias("at")), "lz-order")
    total = numbered.count()
    taker = numbered.select(F.col("doc_id").alias("to_id"), F.col("text_key").alias("to_key"),
                            F.floor(F.col("n_chars") / 3).cast("int").alias("to_take"),
                            F.pmod(F.col("at") + 1, F.lit(max(total, 1))).alias("at"))
    return numbered.join(taker, "at").select("doc_id", "text_key", "to_id", "to_key", "to_take")


PACKED = "known_id long, no_id boolean, text_key long, fingerprint string, packed binary"
STARTS = "to_id long, to_none boolean, to_key long, start binary, next_fingerprint string"
MADE = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit (the last third replaced by
    the start of the next document in descending order of doc_id), and how
    alike they are: ``near_edited``, and ``near_next`` for the next document.

    Whole texts move once, by their key and packed, as their fingerprints are
    made where they are read. A document's start (a third of a text at most)
    and its fingerprint then move to the document before it, also once: keys
    are columns without nulls, by which starts are both told apart and joined.
    Both joins read the same columns of the packed texts, or each would deal its own.
    """
    def key(doc_id: str, known: str, none: str) -> list:
        return [F.coalesce(doc_id, F.lit(0).cast("long")).alias(known), F.col(doc_id).isNull().alias(none)]

    order = materialize(successors(docs), "lz-next")
    order = order.select(*key("doc_id", "known_id", "no_id"), "text_key", *key("to_id", "to_id", "to_none"), "to_key", "to_take")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).select(
        *key("doc_id", "known_id", "no_id"), F.xxhash64("text").alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))

    def pack(batches):
        coder = zstandard.ZstdCompressor()
        for batch in batches:
            yield _batch(PACKED, [(i, none, k, render(signature(phrases(t))), coder.compress(t.encode()))
                                  for i, none, k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)])

    def cut(batches):
        coder, reader = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
        for batch in batches:
            yield _batch(STARTS, [(i, none, k, coder.compress(reader.decompress(p).decode()[:n].encode()), f)
                                  for i, none, k, n, p, f in zip(*(c.to_pylist() for c in batch.columns), strict=True)])

    def edit(batches):
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for i, p, whole, s, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = reader.decompress(p).decode()
                edited = text[:len(text) - len(text) // 3] + reader.decompress(s).decode()
                changed = render(signature(phrases(edited)))
                rows.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), whole, changed, likeness(whole, changed), likeness(whole, after)))
            yield _batch(MADE, rows)

    packed = in_arrow(own, pack, PACKED)
    linked = packed.join(order, ["known_id", "no_id", "text_key"]).select("to_id", "to_none", "to_key", "to_take", "packed", "fingerprint")
    starts = in_arrow(linked, cut, STARTS).dropDuplicates(["to_id", "to_none", "to_key"])
    both = packed.join(starts, (F.col("known_id") == F.col("to_id")) & (F.col("no_id") == F.col("to_none")) & (F.col("text_key") == F.col("to_key")))
    doc_id = F.when(~F.col("no_id"), F.col("known_id")).alias("doc_id")
    return in_arrow(both.select(doc_id, "packed", "fingerprint", "start", "next_fingerprint"), edit, MADE)
