"""SentencePiece byte-fallback BPE, encoded in vectorised merge rounds.

A batch's new words lie end to end in one flat symbol array. Each round finds
the smallest pair rank of every word with a segmented minimum, merges the
leftmost occurrences of that pair in all words at once, and drops words that
have no pair left. Short words already seen come from a memo.

Texts are taken apart in blocks of ``BLOCK`` characters that end between words,
and the memo is bounded in words and in characters a word, so memory follows
these bounds, one batch of Arrow rows of about ``BLOCK`` characters and the
longest text or run without spaces, not a task's texts.

The model must be BPE with the identity normaliser, a dummy prefix, no removal
of extra white space and no piece that has a space mark behind another symbol:
then merges never cross the start of a word, and words are encoded one by one.

Null and empty texts give begin and end ids only. Repeated rows are encoded
alike; other columns of the input pass through untouched, but for one named as
the token ids are, which gives way to them.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starmart.llm.common import in_arrow

SPACE = "▁"
#: A word with the spaces before it, or the spaces that end a text.
SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Where a word starts behind another one.
WORD_START = re.compile(f"(?<=[^{SPACE}]){SPACE}")
#: Characters that are split into words, and merged, at a time.
BLOCK, MERGED = 1 << 20, 1 << 18
#: Longer words are merged anew each time.
MEMO_CHARS = 32
NO_RANK = np.int64(1) << 62


class PieceModel:
    """The pieces of a model file as lookup tables."""

    def __init__(self, path: str, memo_words: int = 200_000):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec, kind = proto.normalizer_spec, proto.trainer_spec
        normal = [(i, p.piece, p.score) for i, p in enumerate(proto.pieces) if p.type == 1]
        if (kind.model_type != 2 or not kind.byte_fallback or spec.precompiled_charsmap
                or not spec.add_dummy_prefix or spec.remove_extra_whitespaces
                or any(p.type in (4, 5) for p in proto.pieces)
                or any(re.search(f"[^{SPACE}]{SPACE}", p) for _, p, _ in normal)):
            raise ValueError(f"{path}: not a byte-fallback BPE model of the supported kind")
        self.bos, self.eos = ({p.piece: i for i, p in enumerate(proto.pieces)}[x] for x in ("<s>", "</s>"))
        self.ids = {p: i for i, p, _ in normal}
        order = {s: r for r, s in enumerate(sorted({-s for _, _, s in normal}))}
        # rank of the merged piece by its id; equal scores share a rank
        self.rank = np.full(len(proto.pieces), NO_RANK, np.int64)
        members: dict[int, int] = {}
        for i, _, s in normal:
            self.rank[i] = order[-s]
            members[order[-s]] = members.get(order[-s], 0) + 1
        self.shared = np.zeros(len(order), bool)
        self.shared[[r for r, n in members.items() if n > 1]] = True
        pairs = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys, self.pair_ids = keys, np.array([pairs[k] for k in keys.tolist()], np.int64)
        self.byte_ids = np.zeros(256, np.int64)
        self.bytes = [b""] * len(proto.pieces)
        for i, p in enumerate(proto.pieces):
            if p.type == 6:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == 1:
                self.bytes[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == 2:
                self.bytes[i] = " ⁇ ".encode()
        self.memo: dict[str, bytes] = {}
        self.memo_words = memo_words

    def merged(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece id and rank of each neighbouring pair; NO_RANK where none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        found = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        piece = np.where(found, self.pair_ids[at], -1)
        return piece, np.where(found, self.rank[piece], NO_RANK)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        text = "".join(words)
        char = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        kinds, inverse = np.unique(char, return_inverse=True)
        # a character outside the vocabulary keeps a negative symbol until the end
        symbol = np.array([self.ids.get(chr(c), -1 - c) for c in kinds.tolist()], np.int64)[inverse] if len(char) else char
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else word
        piece, rank = self.merged(symbol, np.append(symbol[1:], -1)) if len(symbol) else (symbol, symbol)
        rank[np.append(first[1:], len(word)) - 1] = NO_RANK  # no pair crosses the end of a word
        while len(symbol):
            best, sizes = np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word)))
            live = best < NO_RANK
            if not live.all():
                on = np.repeat(live, sizes)
                for w, ids in zip(*self._finished(symbol[~on], word[~on]), strict=True):
                    out[w] = ids
                symbol, word, rank, piece = symbol[on], word[on], rank[on], piece[on]
                best, sizes = best[live], sizes[live]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            # leftmost first: in a run of touching pairs every second one merges
            start = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1))
            take = (at - np.repeat(at[start], np.diff(np.append(start, len(at))))) % 2 == 0
            # pieces that share one rank merge one at a time, as longer ones may come first
            tied = self.shared[rank[at]]
            if tied.any():
                take &= ~tied | np.append(True, word[at][1:] != word[at][:-1])
            at = at[take]
            symbol[at] = piece[at]
            rank[at] = NO_RANK
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, word, rank, piece = symbol[keep], word[keep], rank[keep], piece[keep]
            at -= np.arange(len(at))
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            # only pairs with a merged symbol have a new rank
            left = at[at + 1 < len(word)]
            left = left[word[left] == word[left + 1]]
            before = at[at > 0] - 1
            for pair in (left, before[word[before] == word[before + 1]]):
                piece[pair], rank[pair] = self.merged(symbol[pair], symbol[pair + 1])
        return out

    def _finished(self, symbol: np.ndarray, word: np.ndarray) -> tuple[list[int], list[bytes]]:
        if (symbol < 0).any():
            known = symbol >= 0
            raw = [None if ok else chr(-1 - s).encode() for s, ok in zip(symbol.tolist(), known.tolist(), strict=True)]
            size = np.array([1 if r is None else len(r) for r in raw])
            spread = np.repeat(np.where(known, symbol, 0), size)
            spread[np.repeat(~known, size)] = self.byte_ids[np.frombuffer(b"".join(r for r in raw if r), np.uint8)]
            symbol, word = spread, np.repeat(word, size)
        cut = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        data, ends = symbol.astype("<u4").tobytes(), np.append(cut[1:], len(word)).tolist()
        return word[cut].tolist(), [data[4 * a:4 * b] for a, b in zip(cut.tolist(), ends, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, begin and end ids included, as 32-bit integers."""
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.bos, self.eos))
        out: list[list[bytes]] = [[begin] for _ in texts]
        block: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            for part in parts((" " + text).replace(" ", SPACE)) if text else ():
                block.append((i, SEGMENT.findall(part)))
                size += len(part)
                if size >= BLOCK:
                    self._encode_block(block, out)
                    block, size = [], 0
        self._encode_block(block, out)
        for ids in out:
            ids.append(end)
        return [b"".join(ids) for ids in out]

    def _encode_block(self, block: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        """Append the ids of each part of a block to those of its text."""
        if len(self.memo) > self.memo_words:
            self.memo.clear()
        new = set().union(*(words for _, words in block)).difference(self.memo)
        known = self.memo
        if any(len(w) > MEMO_CHARS for w in new):
            known = _Both(self.memo)
        for some in _sized(new, MERGED):
            for w, ids in zip(some, self.encode_words(some), strict=True):
                (self.memo if len(w) <= MEMO_CHARS else known.own)[w] = ids
        for i, words in block:
            out[i].append(b"".join(map(known.__getitem__, words)))

    def decode(self, ids: bytes) -> str:
        """The text of ids; control ids give nothing, the dummy prefix goes."""
        table = self.bytes
        raw = b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


class _Both:
    """The memo, and the long words of one block beside it."""

    def __init__(self, memo: dict[str, bytes]):
        self.memo, self.own = memo, {}

    def __getitem__(self, word: str) -> bytes:
        return (self.memo if len(word) <= MEMO_CHARS else self.own)[word]


def parts(text: str):
    """A text in parts of about ``BLOCK`` characters that end between words."""
    at = 0
    while len(text) - at > BLOCK and (cut := WORD_START.search(text, at + BLOCK)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def _sized(words, limit: int):
    """Lists of words of about ``limit`` characters, or of one long word."""
    some, size = [], 0
    for word in words:
        if some and size + len(word) > limit:
            yield some
            some, size = [], 0
        some.append(word)
        size += len(word)
    if some:
        yield some


def row_slices(batch: pa.RecordBatch, text: str):
    """A batch in runs of rows whose texts have about ``BLOCK`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)) // BLOCK
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_documents(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` (array of int) in place of the column ``text``. A
    column of the name ``ids`` gives way to the token ids; others pass through."""
    fields = [f for f in docs.schema.fields if f.name not in (text, ids)]
    schema = T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType()), False)])

    def run(batches):
        pieces = model(model_path)
        for batch in (rows for whole in batches for rows in row_slices(whole, text)):
            coded = pieces.encode([x or "" for x in batch.column(text).to_pylist()])
            offsets = np.zeros(len(coded) + 1, np.int32)
            np.cumsum([len(c) // 4 for c in coded], out=offsets[1:])
            flat = np.frombuffer(b"".join(coded), np.int32)
            columns = [batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[*(f.name for f in fields), ids])

    return in_arrow(docs, run, schema)


def token_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document the number of ids and digests of the ids and of what they
    decode to."""

    def run(batches):
        pieces = model(model_path)
        for batch in (rows for whole in batches for rows in row_slices(whole, "text")):
            coded = pieces.encode([x or "" for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([len(c) // 4 for c in coded], pa.int64()),
                pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                pa.array([hashlib.sha256(pieces.decode(c).encode()).hexdigest() for c in coded]),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return in_arrow(
        docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
