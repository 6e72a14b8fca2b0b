"""Alignment of two tokenizers' tokens by the bytes they cover.

A text's tokens of either tokenizer cut the same bytes. Token-byte incidence
matrices A and B (a row per token, a column per byte) are held in CSR arrays
built here, and row products (Gustavson: row i of A·Bᵀ is the sum of the rows
of Bᵀ that row i of A names) give the overlap links, each with the number of
bytes both tokens share. Offsets where tokens of both end cut the text into
groups; products of the group incidence matrices link all tokens of a group.
Products run in blocks of rows, so their memory follows the block.

A link's id pair counts in as many documents as hold it. Documents are packed
some megabytes a row; a pack sends each id pair it holds once, with its number
of documents, so the shuffle follows distinct pairs a pack, and the corpus-wide
counts come back to the pack by the pair's place in it. No pair can hold more
rows than there are packs.

Defined results: null and empty texts, and texts whose joined tokens differ
from a space and the text (a U+2581 in the text, say), have no tokens: zeros
and an empty digest. Every row is a document of its own, so repeated rows and
rows with the same or no doc_id each count and are each returned. Other columns
are ignored (``align_documents`` passes them through). An empty table gives no
rows. Memory follows the pack size or the longest text.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import LARGE_ROWS, in_arrow, lists, materialize
from starmart.session import arrow_batches

#: Bytes of text in a pack, and products a block of rows.
PACK_BYTES = 1 << 19
BLOCK = 1 << 18
#: Documents that a Python task gets at a time, about a pack or two.
BATCH_ROWS = 512
#: Words of the byte-level pre-tokenizer, as its library states them.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Csr:
    """A sparse matrix: the columns and values of each row, end to end."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, data: np.ndarray, columns: int):
        self.indptr, self.indices, self.data, self.columns = indptr, indices, data, columns

    @classmethod
    def of_intervals(cls, ends: np.ndarray, columns: int) -> "Csr":
        """Row i has a one in each column from the end of row i-1 to its own."""
        return cls(np.concatenate(([0], ends)), np.arange(columns, dtype=np.int32), np.ones(columns, np.int32), columns)

    @classmethod
    def of_members(cls, group: np.ndarray, columns: int) -> "Csr":
        """Row i has a one in the column of its group."""
        return cls(np.arange(len(group) + 1), group.astype(np.int32), np.ones(len(group), np.int32), columns)

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def transpose(self) -> "Csr":
        row = np.repeat(np.arange(self.rows, dtype=np.int32), np.diff(self.indptr))
        order = np.argsort(self.indices, kind="stable")
        ptr = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.columns))))
        return Csr(ptr, row[order], self.data[order], self.rows)

    def work(self, other: "Csr") -> np.ndarray:
        """How many products each row of ``self`` · ``other`` adds up."""
        sizes = np.diff(other.indptr)[self.indices]
        return np.diff(np.concatenate(([0], np.cumsum(sizes)))[self.indptr])

    def product_blocks(self, other: "Csr"):
        """(row, column, value) arrays of ``self`` · ``other``, in row order."""
        done = np.concatenate(([0], np.cumsum(self.work(other))))
        first = 0
        while first < self.rows:
            last = max(first + 1, int(np.searchsorted(done, done[first] + BLOCK, "right")) - 1)
            inner = slice(self.indptr[first], self.indptr[last])
            named = self.indices[inner]
            begin, sizes = other.indptr[named], np.diff(other.indptr)[named]
            total = int(sizes.sum())
            if total:
                at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
                row = np.repeat(np.repeat(np.arange(first, last), np.diff(self.indptr[first:last + 1])), sizes)
                key = row * other.columns + other.indices[at]
                value = np.repeat(self.data[inner], sizes) * other.data[at]
                if (key[1:] < key[:-1]).any():
                    order = np.argsort(key, kind="stable")
                    key, value = key[order], value[order]
                start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                yield key[start] // other.columns, key[start] % other.columns, np.add.reduceat(value, start)
            first = last

    def product(self, other: "Csr") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = list(self.product_blocks(other))
        if not found:
            return (np.empty(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class ByteTokens:
    """A byte-level BPE file: ids of texts, without special tokens.

    A vocabulary whose ids follow its merges, cut by the pre-tokenizer's own
    words, is run as ranks, which gives the same ids in less time (checked for
    every code point in tests/llm); any other goes through its library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        shown = sorted(pre_tokenizers.ByteLevel.alphabet())
        printable = [b for b in range(256) if chr(b) in shown and b != 0xAD]
        byte_of = {chr(b): b for b in printable}
        byte_of.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))})
        vocab, model = spec["model"]["vocab"], spec["model"]
        special = {t["content"] for t in spec["added_tokens"] if t["special"]}
        own = {bytes(byte_of[c] for c in piece): i for piece, i in vocab.items() if piece not in special}
        self.bytes = [b""] * (1 + max(own.values()))
        for piece, i in own.items():
            self.bytes[i] = piece
        merged = [vocab[a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        word_cut = spec["pre_tokenizer"] or {}
        ranked = (merged == list(range(256, 256 + len(merged))) and not spec["normalizer"] and not model.get("ignore_merges")
                  and word_cut.get("type") == "ByteLevel" and word_cut.get("use_regex") and not word_cut.get("add_prefix_space"))
        if ranked:
            import tiktoken

            self.ranks = tiktoken.Encoding("alignment", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=own, special_tokens={})
        else:
            self.ranks, self.library = None, Tokenizer.from_file(path)
            self.library.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.ranks is not None:
            return [np.array(self.ranks.encode_ordinary(t), np.int64) for t in texts]
        return [np.array(self.library.encode(t, add_special_tokens=False).ids, np.int64) for t in texts]


class PieceTokens:
    """A sentencepiece file: ids of texts, and each piece's bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.library.encode(texts, num_threads=1)]


@lru_cache(maxsize=4)
def tokenizers_of(byte_path: str, piece_path: str) -> "Aligner":
    return Aligner(ByteTokens(byte_path), PieceTokens(piece_path))


class Alignment:
    """Tokens, links and groups of some texts, end to end."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], size_a: np.ndarray, size_b: np.ndarray):
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        self.a, self.b = (np.concatenate(side) if side else np.empty(0, np.int64) for side in (a, b))
        end_a, end_b = np.cumsum(size_a[self.a]), np.cumsum(size_b[self.b])
        n_bytes = int(end_a[-1]) if len(end_a) else 0
        self.cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(self.cuts, end_a), np.searchsorted(self.cuts, end_b)
        over = Csr.of_intervals(end_a, n_bytes), Csr.of_intervals(end_b, n_bytes)
        #: A token, B token and shared bytes of each link
        self.link_a, self.link_b, self.link_bytes = over[0].product(over[1].transpose())
        self.members = Csr.of_members(self.group_a, len(self.cuts)), Csr.of_members(self.group_b, len(self.cuts))
        self.text_of_a = np.repeat(np.arange(len(a)), self.n_a)
        self.n_links = np.bincount(self.text_of_a[self.link_a], minlength=len(a))
        first = np.concatenate(([True], self.group_a[1:] != self.group_a[:-1])) if len(self.a) else np.empty(0, bool)
        self.n_groups = np.bincount(self.text_of_a[first], minlength=len(a))
        # members are in one group each, so no two products fall on one place
        self.n_shared = np.bincount(self.text_of_a, self.members[0].work(self.members[1].transpose()), len(a)).astype(np.int64)

    def shared_group_links(self):
        """Blocks of (A token, B token): all pairs of tokens in one group."""
        for row, column, _ in self.members[0].product_blocks(self.members[1].transpose()):
            yield row, column

    def group_digests(self, spelled: list[str], offset: int) -> list[str]:
        """SHA-256 of each text's groups, as A ids | B ids ; and so on."""
        g, h = self.group_a, self.group_b
        codes = np.empty(len(g) + len(h), np.int64)
        last_a, last_b = (np.concatenate((x[1:] != x[:-1], [True])) if len(x) else np.empty(0, bool) for x in (g, h))
        codes[np.arange(len(g)) + np.searchsorted(h, g, "left")] = 2 * self.a + last_a
        codes[np.arange(len(h)) + np.searchsorted(g, h, "right")] = offset + 2 * self.b + last_b
        strings = [spelled[c] for c in codes.tolist()]
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return [hashlib.sha256("".join(strings[s:e])[:-1].encode()).hexdigest() if s < e else ""
                for s, e in zip([0, *ends[:-1]], ends, strict=True)]


class Aligner:
    def __init__(self, a, b):
        self.a, self.b = a, b
        self.sizes = tuple(np.array([len(x) for x in side.bytes], np.int64) for side in (a, b))
        self.offset = 2 * len(a.bytes)
        # a token with what follows it: the next of its group, or its group's end
        self.spelled = [s for i in range(len(a.bytes)) for s in (f"{i},", f"{i}|")] + [s for i in range(len(b.bytes)) for s in (f"{i},", f"{i};")]

    def align(self, texts: list[str | None]) -> Alignment:
        texts = [t or "" for t in texts]
        a, b = self.a.encode([" " + t for t in texts]), self.b.encode(texts)
        none = np.empty(0, np.int64)
        for i, t in enumerate(texts):
            data = b" " + t.encode()
            if not t or any(b"".join([side.bytes[x] for x in ids[i].tolist()]) != data for side, ids in ((self.a, a), (self.b, b))):
                a[i] = b[i] = none
        return Alignment(a, b, *self.sizes)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * len(self.b.bytes) + b


def _packs(batches, text: str):
    """Runs of rows of about ``PACK_BYTES`` of text, as (batch slice, texts)."""
    for batch in batches:
        texts = batch.column(text).to_pylist()
        size = np.cumsum([len(t or "") for t in texts])
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(size, (size[first - 1] if first else 0) + PACK_BYTES, "right")))
            yield batch.slice(first, last - first), texts[first:last]
            first = last


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text") -> DataFrame:
    """``docs`` with the column ``alignment``: both sides' ids, the group of
    each token (those of one group are linked), and the overlap links as places
    in the ids with their shared bytes. Places and groups count from 0 a text."""
    part = T.ArrayType(T.IntegerType())
    names = ("a", "b", "group_a", "group_b", "link_a", "link_b", "link_bytes")
    fields = [f for f in docs.schema.fields if f.name != "alignment"]
    schema = T.StructType([*fields, T.StructField("alignment", T.StructType([T.StructField(n, part) for n in names]))])

    def run(batches):
        aligner = tokenizers_of(byte_path, piece_path)
        for batch, texts in _packs(batches, text):
            al = aligner.align(texts)
            cut = {"a": al.n_a, "b": al.n_b, "link": al.n_links}
            cut = {k: np.concatenate(([0], np.cumsum(v))) for k, v in cut.items()}
            group = np.concatenate(([0], np.cumsum(al.n_groups)))
            out = []
            for values, kind, less in ((al.a, "a", None), (al.b, "b", None), (al.group_a, "a", group), (al.group_b, "b", group),
                                       (al.link_a, "link", cut["a"]), (al.link_b, "link", cut["b"]), (al.link_bytes, "link", None)):
                if less is not None:
                    values = values - np.repeat(less[:-1], np.diff(cut[kind]))
                out.append(pa.ListArray.from_arrays(pa.array(cut[kind].astype(np.int32)), pa.array(values.astype(np.int32))))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.StructArray.from_arrays(out, list(names))], names=[*(f.name for f in fields), "alignment"])

    return in_arrow(docs, run, schema)


_PACKED = ("chunk long, pair array<long>, docs array<int>, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
           "n_links array<long>, n_shared array<long>, groups_sha256 array<string>, held array<int>, link array<int>, times array<int>")


def _packed(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """A row a pack: its documents, its id pairs with the number of its
    documents that hold each, and the documents' links as places among these."""

    def run(batches):
        aligner = tokenizers_of(byte_path, piece_path)
        chunk = TaskContext.get().partitionId() << 33
        for batch, texts in _packs(batches, "text"):
            al = aligner.align(texts)
            doc = al.text_of_a[al.link_a]
            pair = aligner.pair(al.a[al.link_a], al.b[al.link_b])
            key, times = np.unique(doc * (len(aligner.a.bytes) * len(aligner.b.bytes)) + pair, return_counts=True)
            holder, pair = np.divmod(key, len(aligner.a.bytes) * len(aligner.b.bytes))
            known, link, n_docs = np.unique(pair, return_inverse=True, return_counts=True)
            ids = batch.column(0)
            row = [lists([known], pa.int64()), lists([n_docs], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
            row += [lists([x], pa.int64()) for x in (al.n_a, al.n_b, al.n_groups, al.n_links, al.n_shared)]
            row.append(pa.array([al.group_digests(aligner.spelled, aligner.offset)], pa.list_(pa.string())))
            row += [lists([x], pa.int32()) for x in (np.bincount(holder, minlength=len(texts)), link, times)]
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *row], names=[c.split()[0] for c in _PACKED.split(", ")])
            chunk += 1

    return in_arrow(docs, run, _PACKED)


def alignment_digests(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Per row of documents: doc_id, n_a, n_b (tokens), n_groups, n_links,
    n_best (links whose id pair is held by most documents of all pairs of its A
    id), count_sum (documents that hold the id pair, over links), groups_sha256,
    n_shared (pairs of tokens that share a group)."""
    pieces = len(tokenizers_of(byte_path, piece_path).b.bytes)
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        packed = materialize(_packed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), byte_path, piece_path), "alignment-packs", LARGE_ROWS)
    pairs = packed.select("chunk", F.posexplode(F.arrays_zip("pair", "docs"))).select("chunk", "pos", "col.pair", "col.docs")
    counts = materialize(pairs.groupBy("pair").agg(F.sum("docs").alias("n")), "alignment-counts")
    a_id = F.expr(f"pair div {pieces}")
    counts = counts.withColumn("a_id", a_id)
    most = counts.groupBy("a_id").agg(F.max("n").alias("most"))
    rated = materialize(counts.join(most, "a_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-rates")
    looked = pairs.select("chunk", "pos", "pair").join(rated, "pair").select(F.col("chunk").alias("of"), "pos", "n", "best")
    whole = ("n_a", "n_b", "n_groups", "n_links", "n_shared")

    def run(pack, found):
        row = {n: pack.column(n).combine_chunks().flatten() for n in pack.column_names if n != "chunk"}
        held, link, times = (row[n].to_numpy(zero_copy_only=False) for n in ("held", "link", "times"))
        pos, count, top = (found.column(n).to_numpy() for n in ("pos", "n", "best"))
        n, best = np.zeros((2, len(pos)), np.int64)
        n[pos], best[pos] = count, top
        ends = np.concatenate(([0], np.cumsum(held)))
        sums = [np.concatenate(([0], np.cumsum(times * x[link]))) for x in (best, n)]
        best_sum, count_sum = (pa.array(s[ends[1:]] - s[ends[:-1]], pa.int64()) for s in sums)
        return pa.table([row["doc_id"], *(row[c] for c in whole[:4]), best_sum, count_sum, row["groups_sha256"], row["n_shared"]],
                        names=["doc_id", *whole[:4], "n_best", "count_sum", "groups_sha256", "n_shared"])

    # a pack meets its pairs as sorted runs: its row and theirs are in memory, no other's
    return packed.drop("pair", "docs").groupBy("chunk").cogroup(looked.groupBy("of")).applyInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_shared long")
