"""Removal of long repeated byte spans with a sparse suffix array.

Every window of ``window`` bytes holds an anchor, the place of its least
``anchor``-byte hash, so equal windows have equal anchors at equal offsets, and
only the suffixes at anchors need sorting (about one in 16 bytes). Neighbouring
windows with one anchor form a piece: the anchor, the bytes before and after it
that its windows reach, and a document.

1. Texts are packed some megabytes a row. Each pack sends the fingerprints of
   its anchors, 4 bytes each, to shards of the hash space and learns which ones
   another pack has too. No other piece can repeat.
2. Sampled splitters range-partition the remaining pieces by their suffix (the
   bytes from the anchor on, then those before it backwards, then the
   document), so that equal suffixes can be cut as well and no bucket is hot.
3. A bucket sorts its suffixes, and the reversed prefixes, by multikey quicksort
   over 8-byte characters. Common prefix lengths of neighbours give the classes
   of equal windows for each offset of the anchor, and each class its first
   document. All comparisons are of bytes; hashes only choose what to compare.
4. A class whose suffix equals the splitter at the bucket's edge may go on in
   the next bucket. Its window goes to a comparison across boundaries, one row
   for each first document a bucket found.

Removed are the bytes that a window covers whose bytes also start a window in a
document with a smaller doc_id.

Defined results: null and empty texts have no bytes; texts shorter than the
window are kept whole; rows that share a doc_id are one source, so repeats
between them are kept; rows with a null doc_id are kept whole. Repeated rows
are returned each, other columns are ignored, an empty table gives no rows.
Memory follows the pack size or the longest text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import in_arrow, lists, materialize, mix, runs

#: Bytes of text a pack, a block of hashed places, a shard of fingerprints
#: (in bytes of text), and suffixes a bucket.
PACK_BYTES, BLOCK, SHARD_BYTES, BUCKET_SUFFIXES = 2 << 20, 1 << 18, 64 << 20, 200_000
#: Packs that the splitters are sampled from at least (of more, one in
#: SAMPLE_EVERY), and sampled suffixes a bucket.
SAMPLE_PACKS, SAMPLE_EVERY, SAMPLES = 16, 64, 16
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def anchor_hashes(data: np.ndarray, anchor: int) -> np.ndarray:
    """A hash of every ``anchor`` (8 or more) neighbouring bytes."""
    n = len(data) - anchor + 1
    eight = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), 0, (1,))
    out = np.zeros(n, np.uint64)
    for i, at in enumerate([*range(0, anchor - 8, 8), anchor - 8]):
        out += eight[at:at + n] * _MULTIPLIERS[i % 4]
        out = mix(out) if i % 4 == 3 else out
    return mix(out)


class Shape:
    """Sizes of windows and anchors, and the layout of a suffix record."""

    def __init__(self, window: int, anchor: int):
        if not 8 <= anchor <= window:
            raise ValueError("an anchor has 8 bytes or more and fits the window")
        self.window, self.anchor, self.before, self.block = window, anchor, window - anchor, BLOCK
        self.record = np.dtype([("after", "u1", (window,)), ("before", "u1", (max(self.before, 1),)),
                                ("doc", ">u8"), ("low", "<u2"), ("high", "<u2"), ("place", "<i4")])
        #: bytes of a record that order it: the suffix, the prefix, the document
        self.key = window + max(self.before, 1) + 8

    def pieces(self, data: np.ndarray, ends: np.ndarray, own: np.ndarray):
        """Anchor, first window, windows and anchor hash of each piece, for the
        texts that end at ``ends`` and are ``own``."""
        found = []
        stop = np.repeat(np.where(own, ends, 0), np.diff(np.concatenate(([0], ends))))
        for first in range(0, max(len(data) - self.window + 1, 0), self.block):
            part = data[first:first + self.block + self.window - 1]
            h = anchor_hashes(part, self.anchor)
            # the leftmost of the least: its place stands in the low bits
            bits = (self.block + self.window).bit_length()
            least = sliding_least(h >> np.uint64(bits) << np.uint64(bits) | np.arange(len(h), dtype=np.uint64), self.before + 1)
            start = np.flatnonzero(np.arange(first, first + len(least)) + self.window <= stop[first:first + len(least)])
            least = least[start]
            s, e = runs(least)
            at = (least[s] & np.uint64((1 << bits) - 1)).astype(np.int64)
            found.append((at + first, start[s] + first, e - s, h[at]))
        if not found:
            return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def records(self, data: np.ndarray, at: np.ndarray, start: np.ndarray, n: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The suffix records of pieces; bytes no window reaches are zero."""
        out = np.zeros(len(at), self.record)
        out["low"], out["high"] = at - start - n + 1, at - start
        out["doc"] = doc.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)  # order of signed numbers
        padded = np.concatenate((np.zeros(self.before, np.uint8), data, np.zeros(self.window, np.uint8)))
        for i in range(0, len(at), 50_000):
            part = slice(i, i + 50_000)
            q = at[part, None] + self.before
            k = np.arange(self.window)
            out["after"][part] = np.where(k < self.window - out["low"][part, None].astype(np.int64), padded[q + k], 0)
            if self.before:
                k = np.arange(self.before)
                out["before"][part] = np.where(k < out["high"][part, None], padded[q - 1 - k], 0)
        return out

    def words(self, records: np.ndarray, *names: str) -> np.ndarray:
        """The named byte columns as 8-byte characters, first ones on top."""
        columns = []
        for name in names:
            b = records[name]
            if name == "doc":
                columns.append(b.astype(np.uint64)[:, None])
                continue
            wide = np.zeros((len(b), -(-b.shape[1] // 8) * 8), np.uint8)
            wide[:, :b.shape[1]] = b
            columns.append(wide.view(">u8").astype(np.uint64))
        return np.concatenate(columns, axis=1)

    def keys(self, records: np.ndarray) -> np.ndarray:
        return np.ndarray((len(records),), f"S{self.key}", np.ascontiguousarray(records).tobytes(), 0, (self.record.itemsize,))

    def distinct(self, records: np.ndarray):
        """Order of records by key and reach, and the first of each text content
        within it: the least document that has it."""
        words = self.words(records, "after", "before")
        reach = (records["low"].astype(np.uint64) << np.uint64(16)) | records["high"]
        order = multikey_order(np.concatenate((words, reach[:, None], self.words(records, "doc")), axis=1))
        same = (words[order][1:] == words[order][:-1]).all(axis=1) & (reach[order][1:] == reach[order][:-1])
        return order, np.flatnonzero(np.concatenate(([True], ~same))) if len(order) else np.empty(0, np.int64)


def multikey_order(words: np.ndarray) -> np.ndarray:
    """The order of rows of characters: sorted by the first, and only rows that
    are equal so far by the next one."""
    order = np.argsort(words[:, 0], kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = words[order[1:], 0] != words[order[:-1], 0]
    for k in range(1, words.shape[1]):
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        run = np.cumsum(new)[at]
        rows = order[at]
        rows = rows[np.lexsort((words[rows, k], run))]
        order[at] = rows
        new[at[1:]] |= (words[rows[1:], k] != words[rows[:-1], k])
    return order


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bytes the rows of ``a`` share with those of ``b``."""
    same = a == b
    return np.where(same.all(axis=1), a.shape[1], same.argmin(axis=1))


class Bucket:
    """One range of suffixes: the windows an earlier document has, and those of
    its edges that a neighbour may have."""

    def __init__(self, shape: Shape, records: np.ndarray, below: bytes | None, above: bytes | None):
        n, w = len(records), shape.window
        doc = records["doc"].astype(np.uint64)
        classes = []
        for name in ("after", "before"):
            order = multikey_order(shape.words(records, name))
            b = records[name][order]
            classes.append((order, common(b[1:], b[:-1])))
        edge = np.zeros(n, np.int64)
        for key in (below, above):
            if key is not None:
                split = np.frombuffer(key.ljust(shape.key, b"\0")[:w], np.uint8)
                edge = np.maximum(edge, common(records["after"], np.broadcast_to(split, (n, w))))
        self.mask = np.zeros(n, np.uint64)
        self.asked: list[tuple[np.ndarray, int]] = []
        low, high = records["low"], records["high"]
        for offset in range(shape.before + 1):
            rows = np.flatnonzero((low <= offset) & (offset <= high))
            if not len(rows):
                continue
            number = []
            for (order, lcp), length in zip(classes, (w - offset, offset), strict=True):
                of = np.empty(n, np.int64)
                of[order] = np.concatenate(([0], np.cumsum(lcp < length)))
                number.append(of[rows])
            key = number[0] * n + number[1]
            order = np.argsort(key, kind="stable")
            s, e = runs(key[order])
            first = np.repeat(np.minimum.reduceat(doc[rows[order]], s), e - s)
            later = doc[rows[order]] > first
            self.mask[rows[order[later]]] |= np.uint64(1 << offset)
            rest = rows[order[~later]]
            rest = rest[edge[rest] >= w - offset]
            if len(rest):
                self.asked.append((rest, offset))

    @staticmethod
    def windows(records: np.ndarray, rows: np.ndarray, offset: int) -> np.ndarray:
        after, before = records["after"][rows], records["before"][rows]
        return np.concatenate((before[:, :offset][:, ::-1], after[:, :after.shape[1] - offset]), axis=1)


def _squeezed(data: bytes) -> bytes:
    """Compressed bytes; shuffles and scratch tables carry these."""
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _opened(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


_PACKS = "chunk long, doc_id array<long>, size array<int>, data binary"


def _packed(docs: DataFrame) -> DataFrame:
    pack_bytes = PACK_BYTES

    def run(batches):
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            size = np.cumsum([len(t or b"") for t in texts])
            first = 0
            while first < len(texts):
                last = max(first + 1, int(np.searchsorted(size, (size[first - 1] if first else 0) + pack_bytes, "right")))
                part = [t or b"" for t in texts[first:last]]
                ids = batch.column(0).slice(first, last - first)
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk], pa.int64()), pa.ListArray.from_arrays(pa.array([0, last - first], pa.int32()), ids),
                    lists([np.array([len(t) for t in part])], pa.int32()), pa.array([_squeezed(b"".join(part))], pa.binary())],
                    names=["chunk", "doc_id", "size", "data"])
                chunk, first = chunk + 1, last

    return in_arrow(docs, run, _PACKS)


class Pack:
    """A pack's texts, their pieces, and which of them another pack has."""

    def __init__(self, shape: Shape, row: dict, shards: int):
        self.shape, self.shards, self.chunk = shape, shards, row["chunk"]
        self.data = np.frombuffer(_opened(row["data"]), np.uint8)
        self.ends = np.cumsum(np.array(row["size"], np.int64))
        self.ids = row["doc_id"]
        self.own = np.array([i is not None for i in self.ids], bool)
        self.at, self.start, self.n, h = shape.pieces(self.data, self.ends, self.own)
        self.doc = np.array([i or 0 for i in self.ids], np.int64)[np.searchsorted(self.ends, self.start, "right")]
        self.print = (h >> np.uint64(32)) % np.uint64(shards) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)

    def prints(self):
        """(shard, fingerprints): each anchor once, sorted."""
        known = np.unique(self.print)
        shard = (known >> np.uint64(32)).astype(np.int64)
        for s, e in zip(*runs(shard), strict=True):
            yield int(shard[s]), known[s:e].astype(np.uint32)

    def shared(self, bits: list | None) -> np.ndarray:
        """The pieces whose anchors stand in several documents."""
        known, inverse = np.unique(self.print, return_inverse=True)
        low, high = np.full(len(known), np.iinfo(np.int64).max), np.full(len(known), np.iinfo(np.int64).min)
        np.minimum.at(low, inverse, self.doc)
        np.maximum.at(high, inverse, self.doc)
        hit = low < high
        shard = (known >> np.uint64(32)).astype(np.int64)
        spans = dict(zip(shard[runs(shard)[0]].tolist(), zip(*runs(shard), strict=True), strict=True))
        for b in bits or []:
            s, e = spans[b["shard"]]
            hit[s:e] |= np.unpackbits(np.frombuffer(b["bits"], np.uint8), count=e - s).astype(bool)
        return np.flatnonzero(hit[inverse])

    def suffixes(self, bits: list | None):
        """The shared pieces, their order, the first of each content in it, and
        the sorted records of these."""
        pieces = self.shared(bits)
        records = self.shape.records(self.data, *(x[pieces] for x in (self.at, self.start, self.n, self.doc)))
        order, first = self.shape.distinct(records)
        out = records[order[first]]
        out["place"] = np.arange(len(first))
        return pieces, order, first, out

    def removed(self, bits: list | None, places: np.ndarray, masks: np.ndarray) -> np.ndarray:
        """Whether each byte goes, given the windows found in earlier documents
        for the first document of each content."""
        pieces, order, first, _ = self.suffixes(bits)
        mask = np.zeros(len(first), np.uint64)
        np.bitwise_or.at(mask, places, masks.astype(np.int64).view(np.uint64))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        pieces = pieces[order]
        whole = self.doc[pieces] > self.doc[pieces[first]][group]
        mask = np.where(whole, ~np.uint64(0), mask[group])
        some = np.flatnonzero(mask)
        marks = np.zeros(len(self.data) + 1, np.int64)
        p, mask = pieces[some], mask[some]
        for offset in range(self.shape.before + 1):
            hit = (mask >> np.uint64(offset) & np.uint64(1)).astype(bool)
            hit &= (self.at[p] - self.start[p] >= offset) & (self.at[p] - self.start[p] - self.n[p] < offset)
            s = self.at[p[hit]] - offset
            marks += np.bincount(s, minlength=len(marks)) - np.bincount(s + self.shape.window, minlength=len(marks))
        return np.cumsum(marks[:-1]) > 0


def _pack_rows(batches):
    for batch in batches:
        for i in range(len(batch)):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def _shared_prints(packs: DataFrame, shape: Shape, shards: int) -> DataFrame:
    """chunk, bits: of each shard a bit per fingerprint that several packs have."""

    def run(batches):
        for row in _pack_rows(batches):
            found = list(Pack(shape, row, shards).prints())
            yield pa.RecordBatch.from_arrays([
                pa.array([s for s, _ in found], pa.int32()), pa.array([row["chunk"]] * len(found), pa.int64()),
                pa.array([f.astype("<u4").tobytes() for _, f in found], pa.binary())], names=["shard", "chunk", "prints"])

    def meet(table: pa.Table) -> pa.Table:
        own = [np.frombuffer(p, "<u4") for p in table.column("prints").to_pylist()]
        every = np.sort(np.concatenate(own))
        several = np.unique(every[1:][every[1:] == every[:-1]])
        bits = []
        for p in own:
            at = np.minimum(np.searchsorted(several, p), max(len(several) - 1, 0))
            bits.append(np.packbits(several[at] == p).tobytes() if len(several) else b"")
        keep = pa.array([any(b) for b in bits])
        out = pa.table({"chunk": table.column("chunk"), "shard": table.column("shard"), "bits": pa.array(bits, pa.binary())})
        return out.filter(keep)

    prints = in_arrow(packs, run, "shard int, chunk long, prints binary")
    met = materialize(prints.groupBy("shard").applyInArrow(meet, "chunk long, shard int, bits binary"), "suffix-prints")
    return met.groupBy("chunk").agg(F.collect_list(F.struct("shard", "bits")).alias("bits"))


def _with(packs: DataFrame, other: DataFrame) -> DataFrame:
    return packs.join(other, "chunk", "left")


def _splitters(rows: DataFrame, shape: Shape, shards: int, n_packs: int) -> list[bytes]:
    """Suffix keys that cut the suffixes into even buckets, from a sample: at
    least SAMPLE_PACKS packs or one in SAMPLE_EVERY, SAMPLES keys a bucket."""
    every = max(1, min(SAMPLE_EVERY, n_packs // SAMPLE_PACKS))
    step = max(1, BUCKET_SUFFIXES // SAMPLES // every)

    def run(batches):
        for row in _pack_rows(batches):
            pack = Pack(shape, row, shards)
            records = pack.suffixes(row["bits"])[3]
            picked = shape.keys(records[step // 2::step])
            yield pa.RecordBatch.from_arrays([pa.array([len(records)], pa.int64()), pa.array([picked.tolist()], pa.list_(pa.binary()))], names=["n", "keys"])

    sample = in_arrow(rows.where(F.pmod(F.xxhash64("chunk"), F.lit(every)) == 0), run, "n long, keys array<binary>").collect()
    total = sum(r["n"] for r in sample) * n_packs // max(len(sample), 1)
    keys = sorted(bytes(k) for r in sample for k in r["keys"])
    buckets = min(len(keys), -(-total // BUCKET_SUFFIXES))
    return sorted({keys[len(keys) * i // buckets] for i in range(1, buckets)})


_FOUND = "chunk long, place array<int>, mask array<long>, window binary, doc long, offset int"


def _found(rows: DataFrame, shape: Shape, shards: int, splitters: list[bytes]) -> DataFrame:
    """Masks of the windows found in earlier documents, and the windows to be
    compared across boundaries."""
    cuts = np.array(splitters, f"S{shape.key}")

    def run(batches):
        for row in _pack_rows(batches):
            records = Pack(shape, row, shards).suffixes(row["bits"])[3]
            edge = np.concatenate(([0], np.searchsorted(shape.keys(records), cuts), [len(records)])).astype(int)
            part = [(i, records[a:b]) for i, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if a < b]
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in part], pa.int32()), pa.array([row["chunk"]] * len(part), pa.int64()),
                pa.array([_squeezed(r.tobytes()) for _, r in part], pa.binary())], names=["bucket", "chunk", "records"])

    def sort(table: pa.Table) -> pa.Table:
        i = table.column("bucket")[0].as_py()
        own = [np.frombuffer(_opened(r), shape.record) for r in table.column("records").to_pylist()]
        records = np.concatenate(own)
        chunk = np.repeat(table.column("chunk").to_numpy(), [len(r) for r in own])
        bucket = Bucket(shape, records, splitters[i - 1] if i else None, splitters[i] if i < len(splitters) else None)
        hit = np.flatnonzero(bucket.mask)
        hit = hit[np.argsort(chunk[hit], kind="stable")]
        s, e = runs(chunk[hit])
        out = [pa.table({
            "chunk": pa.array(chunk[hit[s]], pa.int64()), "place": lists([records["place"][hit[a:b]] for a, b in zip(s, e, strict=True)], pa.int32()),
            "mask": lists([bucket.mask[hit[a:b]].view(np.int64) for a, b in zip(s, e, strict=True)], pa.int64()),
            "window": pa.nulls(len(s), pa.binary()), "doc": pa.nulls(len(s), pa.int64()), "offset": pa.nulls(len(s), pa.int32())})]
        for rows, offset in bucket.asked:
            doc = (records["doc"][rows].astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
            out.append(pa.table({
                "chunk": pa.array(chunk[rows], pa.int64()), "place": lists([records["place"][r:r + 1] for r in rows.tolist()], pa.int32()),
                "mask": lists([np.array([np.uint64(1 << offset)]).view(np.int64)] * len(rows), pa.int64()),
                "window": pa.array([w.tobytes() for w in bucket.windows(records, rows, offset)], pa.binary()),
                "doc": pa.array(doc, pa.int64()), "offset": pa.array([offset] * len(rows), pa.int32())}))
        return pa.concat_tables(out)

    sent = in_arrow(rows, run, "bucket int, chunk long, records binary")
    return materialize(sent.groupBy("bucket").applyInArrow(sort, _FOUND), "suffix-found")


def remove_repeated_bytes(docs: DataFrame, window: int = 50, anchor: int = 20, kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row, and the kept
    bytes (a cut may fall inside a character) if ``kept``."""
    shape = Shape(window, anchor)
    if shape.before > 63:
        raise ValueError("window - anchor is at most 63")
    packs = materialize(_packed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "suffix-packs")
    n_packs, n_bytes = packs.agg(F.count("*"), F.coalesce(F.sum(F.expr("aggregate(size, 0L, (s, x) -> s + x)")), F.lit(0))).first()
    shards = max(1, -(-n_bytes // SHARD_BYTES))
    bits = materialize(_shared_prints(packs, shape, shards), "suffix-shared")
    rows = _with(packs, bits)
    found = _found(rows, shape, shards, _splitters(rows, shape, shards, n_packs))
    asked = found.where("window IS NOT NULL")
    first = asked.groupBy("window").agg(F.min("doc").alias("first_doc"))
    across = asked.join(first, "window").where("doc > first_doc").select("chunk", "place", "mask")
    masks = (found.where("window IS NULL").select("chunk", "place", "mask").unionByName(across).groupBy("chunk")
             .agg(F.flatten(F.collect_list("place")).alias("place"), F.flatten(F.collect_list("mask")).alias("mask")))

    def run(batches):
        for row in _pack_rows(batches):
            pack = Pack(shape, row, shards)
            gone = pack.removed(row["bits"], np.array(row["place"] or [], np.int64), np.array(row["mask"] or [], np.int64))
            begin = np.concatenate(([0], pack.ends[:-1])).tolist()
            out = []
            for s, e in zip(begin, pack.ends.tolist(), strict=True):
                g = gone[s:e]
                rest = pack.data[s:e][~g].tobytes()
                spans = int(np.count_nonzero(g[1:] & ~g[:-1])) + bool(len(g) and g[0])
                out.append((e - s, e - s - len(rest), spans, hashlib.sha256(rest).hexdigest(), *([rest] if kept else [])))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(pack.ids, pa.int64()), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=False))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if kept else [])])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if kept else "")
    return in_arrow(_with(rows, masks), run, schema)
