"""Removal of long repeated word spans by compacting a de Bruijn graph.

Runs of ``window`` consecutive words are the edges of a de Bruijn graph of the
corpus. Paths are compacted before anything is shuffled: consecutive windows
whose least ``anchor``-word hash is the same form one path piece, described by
that anchor, a hash of the words it covers, and its source coordinates. Equal
windows always have equal anchors, so all that follows joins on anchors:

* An anchor whose pieces are all equal is a nonbranching stretch. Its windows
  belong together, and the piece's first document settles all of them at once.
* At a branching anchor pieces differ (repeats that start or end there). Each
  distinct piece is spelled out into window hashes, read at the coordinates of
  its first occurrence, and the windows' first documents are joined back.

Removed are the words that a window covers whose words also start a window in
a document with a smaller doc_id.

Defined results: null and empty texts have no words; texts shorter than the
window are kept whole; rows that share a doc_id are one source, so repeats
between them are kept; rows with a null doc_id are kept whole. Repeated rows
are returned each. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import WordHashes, in_arrow, materialize, mix, runs

_BASE = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_BASE, -1, 1 << 64)


class Spans:
    """Hashes of all runs of some length in a sequence of word hashes."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, h: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(h):
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                table = np.full(2 * len(h) + 1, np.uint64(base), np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))
        out = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * self.up[:len(h)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start, end) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start])


def least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def pieces(h: np.ndarray, spans: Spans, window: int, anchor: int):
    """Anchor, content hash, first window and number of windows of each piece."""
    if len(h) < window:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    sums = spans.sums(h)
    at = np.arange(len(h) - anchor + 1)
    least = least_in(spans.of(sums, at, at + anchor), window - anchor + 1)
    start, end = runs(least)
    return least[start], spans.of(sums, start, end + window - 1) + (end - start).astype(np.uint64), start, end - start


PIECE = "anchor long, content long, doc_id long, start int, windows int"


def _pieces(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batches):
        hashes, spans = WordHashes(lower=False), Spans()
        for batch in batches:
            made = [pieces(h, spans, window, anchor) for h in hashes.of(batch.column(1).to_pylist())]
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(m[0]) for m in made])
            a, c, s, n = (np.concatenate(x) if x else np.empty(0) for x in (list(zip(*made, strict=True)) or [()] * 4))
            for i in range(0, len(ids), 100_000):
                part = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[part].view(np.int64)), pa.array(c[part].view(np.int64)), pa.array(ids[part], pa.int64()),
                     pa.array(s[part].astype(np.int32)), pa.array(n[part].astype(np.int32))],
                    names=["anchor", "content", "doc_id", "start", "windows"])

    return in_arrow(docs, run, PIECE)


def _spelled(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(anchor, content, place, hash): the windows of the wanted pieces."""
    rows = docs.join(wanted.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "content", "start", "windows")).alias("p"))
                     .withColumnRenamed("doc_id", "source"), F.col("doc_id") == F.col("source")).select(
        "text", F.col("p.anchor").alias("anchor"), F.col("p.content").alias("content"), F.col("p.start").alias("start"), F.col("p.windows").alias("windows"))

    def run(batches):
        hashes, spans = WordHashes(lower=False), Spans()
        for batch in batches:
            for h, a, c, s, n in zip(hashes.of(batch.column("text").to_pylist()), *(batch.column(x).to_pylist() for x in ("anchor", "content", "start", "windows")), strict=True):
                s, n, a, c = np.array(s), np.array(n), np.array(a, np.int64), np.array(c, np.int64)
                sums = spans.sums(h)
                end = np.minimum(s + n + window - 1, len(h))
                # another text of this id may say something else here
                own = (s < end) & ((spans.of(sums, np.minimum(s, end), end) + n.astype(np.uint64)).view(np.int64) == c)
                s, n, a, c = s[own], n[own], a[own], c[own]
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                first = np.repeat(s, n) + place
                found = spans.of(sums, first, first + window).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(x, n), pa.int64()) for x in (a, c)]
                    + [pa.array(place.astype(np.int32)), pa.array(found)], names=["anchor", "content", "place", "hash"])

    return in_arrow(rows, run, "anchor long, content long, place int, hash long")


def covered_windows(docs: DataFrame, window: int = 50, anchor: int = 20) -> DataFrame:
    """doc_id, start, windows: runs of windows that an earlier document has."""
    found = _pieces(docs, window, anchor)
    # pre-aggregated: one row for each distinct piece of an anchor
    distinct = materialize(
        found.groupBy("anchor", "content").agg(
            F.min(F.struct("doc_id", "start", "windows")).alias("first"), F.max("doc_id").alias("last")), "pieces")
    shared = (distinct.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("first.doc_id").alias("a"), F.max("last").alias("b"))
              .where("a < b").select("anchor", (F.col("kinds") > 1).alias("branching")))
    known = materialize(distinct.join(shared, "anchor").select(
        "anchor", "content", "branching", F.col("first.doc_id").alias("doc_id"), F.col("first.start").alias("start"),
        F.col("first.windows").alias("windows"), F.col("last")), "shared-pieces")
    branching = known.where("branching")
    spelled = materialize(_spelled(docs, branching.select("doc_id", "anchor", "content", "start", "windows"), window), "windows")
    sources = spelled.join(branching.select("anchor", "content", "doc_id"), ["anchor", "content"])
    first = sources.groupBy("hash").agg(F.min("doc_id").alias("first_doc"))
    sources = (spelled.join(first, "hash").groupBy("anchor", "content")
               .agg(F.array_sort(F.collect_list(F.struct("place", "first_doc"))).alias("places")))
    # a piece's own first document, or that of each of its windows
    ways = (known.where("NOT branching AND doc_id < last").select("anchor", "content", F.col("doc_id").alias("whole"), F.lit(None).cast("array<struct<place:int,first_doc:bigint>>").alias("places"))
            .unionByName(sources.select("anchor", "content", F.lit(None).cast("long").alias("whole"), "places")))
    hit = found.join(ways, ["anchor", "content"]).where("places IS NOT NULL OR doc_id > whole")
    whole = hit.where("places IS NULL").select("doc_id", "start", "windows")
    parts = (hit.where("places IS NOT NULL")
             .select("doc_id", "start", F.explode(F.expr("filter(places, p -> p.first_doc < doc_id)")).alias("p"))
             .select("doc_id", (F.col("start") + F.col("p.place")).alias("start"), F.lit(1).alias("windows")))
    return whole.unionByName(parts)


def remove_repeats(docs: DataFrame, window: int = 50, anchor: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text) and its digest, per row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    covered = covered_windows(docs.where("doc_id IS NOT NULL"), window, anchor)
    spans = (covered.groupBy("doc_id").agg(F.collect_set(F.struct("start", "windows")).alias("spans"))
             .withColumnRenamed("doc_id", "hit_id"))
    rows = docs.join(spans, F.col("doc_id") == F.col("hit_id"), "left").select(
        "doc_id", "text", F.col("spans.start").alias("start"), F.col("spans.windows").alias("windows"))

    def run(batches):
        for batch in batches:
            out = []
            for text, start, windows in zip(*(batch.column(c).to_pylist() for c in ("text", "start", "windows")), strict=True):
                words = (text or "").encode().split()
                if start:
                    marks = np.zeros(len(words) + 1, np.int32)
                    s = np.array(start)
                    e = s + np.array(windows) + window - 1
                    np.add.at(marks, s[e <= len(words)], 1)
                    np.add.at(marks, e[e <= len(words)], -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(marks[:-1]) == 0).tolist()]
                else:
                    kept = words
                joined = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), joined.decode(), hashlib.sha256(joined).hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return in_arrow(rows, run, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
