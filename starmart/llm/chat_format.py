"""Chat formatting by token-level assembly.

Every turn is encoded on its own, where it is read: role and text go through a
byte-level tokenizer as separate segments, so no merge spans a boundary. The
turn's token row then splices reserved ids, which no text can produce, around
the segments::

    <s> role [INST] text </s>        (one ``<s>`` per turn opens it)

and derives the loss mask from the segment lengths by a prefix sum over +1/-1
marks. Control strings that occur inside a role or text get an escape mark
before they are encoded; it is taken out again when the tokens are read back.

Defined results: a null role or text counts as empty; turns of a conversation
are ordered by turn, then role, then text, nulls first; repeated rows stay
repeated turns; a null conv_id is a conversation of its own; an empty table
gives an empty result. Columns beyond conv_id, turn, role, text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import in_arrow

#: Reserved marks of the template, in the order of their ids.
MARKS = ("<s>", "[INST]", "</s>", "[/INST]", "<pad>")
_CONTROL = re.compile("|".join(f"{re.escape(m[0])}(\\\\*){re.escape(m[1:])}" for m in MARKS))
_ESCAPED = re.compile("|".join(f"{re.escape(m[0])}\\\\(\\\\*){re.escape(m[1:])}" for m in MARKS))


def escape(text: str) -> str:
    """Put one more backslash behind the first character of control strings."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


class ChatTemplate:
    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.base = max(ranks.values()) + 1  # the reserved ids start above every text id

    def segments(self, texts: list[str]) -> list[list[int]]:
        return [self.coder.encode_ordinary(escape(t)) for t in texts]

    def splice(self, role: list[int], text: list[int], assistant: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of one turn, and its loss mask."""
        begin, body, end = self.base, self.base + 1, self.base + 2
        ids = np.concatenate(([begin], role, [body], text, [end])).astype(np.int32)
        marks = np.zeros(len(ids) + 1, np.int32)
        if assistant:
            at = len(role) + 2
            marks[at] += 1
            marks[at + len(text)] -= 1
        return ids, np.cumsum(marks)[:-1].astype(bool)

    def text(self, ids: np.ndarray) -> str:
        return self.coder.decode_bytes(ids.tolist()).decode("utf-8")

    def read_turn(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str, int]:
        """Role, text, text under the mask, code points of the formatted turn."""
        marks = np.flatnonzero(ids >= self.base)
        if ids[marks].tolist() != [self.base, self.base + 1, self.base + 2] or marks[0] != 0 or marks[2] != len(ids) - 1:
            raise ValueError("not a formatted turn")
        role, text = self.text(ids[1:marks[1]]), self.text(ids[marks[1] + 1:marks[2]])
        loss = unescape(self.text(ids[mask])) if mask.any() else ""
        size = len(role) + len(text) + sum(len(MARKS[i]) for i in (ids[marks] - self.base).tolist())
        return unescape(role), unescape(text), loss, size


@lru_cache(maxsize=2)
def template(ranks_path: str, pattern: str) -> ChatTemplate:
    return ChatTemplate(ranks_path, pattern)


TURN = "conv_id long, turn long, role string, text string, ids array<int>, loss array<boolean>"


def format_turns(conversations: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per turn: its ids and its loss mask, encoded where it is read."""

    def run(batches):
        chat = template(ranks_path, pattern)
        for batch in batches:
            roles, texts = ([x or "" for x in batch.column(c).to_pylist()] for c in ("role", "text"))
            known = {r: s for r, s in zip(set(roles), chat.segments(list(set(roles))), strict=True)}
            made = [chat.splice(known[r], t, r == "assistant") for r, t in zip(roles, chat.segments(texts), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("conv_id"), batch.column("turn"), batch.column("role"), batch.column("text"),
                pa.array([m[0] for m in made], pa.list_(pa.int32())),
                pa.array([m[1] for m in made], pa.list_(pa.bool_())),
            ], names=["conv_id", "turn", "role", "text", "ids", "loss"])

    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return in_arrow(rows, run, TURN)


def format_conversations(conversations: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The token stream of each conversation in pieces of one turn: ``start``
    is the place of the piece's first id, a prefix sum of the turns before."""
    turns = format_turns(conversations, ranks_path, pattern)
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    return turns.select(
        "conv_id", "turn", "ids", "loss",
        F.coalesce(F.sum(F.size("ids").cast("long")).over(before), F.lit(0).cast("long")).alias("start"))


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, n_tokens long, loss_tokens long")


def conversation_digests(conversations: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Digests of each conversation, read back from its formatted tokens.

    The turns of a conversation arrive sorted and are hashed as they stream
    by, so a conversation of any length needs the memory of one batch.
    """
    turns = format_turns(conversations, ranks_path, pattern)
    ordered = (turns.repartition("conv_id")
               .sortWithinPartitions("conv_id", "turn", "role", "text")
               .select("conv_id", "ids", "loss"))

    def run(batches):
        chat = template(ranks_path, pattern)
        key, state, none = None, None, True
        done: list[tuple] = []

        def close():
            if not none:
                n, turn_hash, chars, loss_hash, size, tokens, masked = state
                done.append((key, n, turn_hash.hexdigest(), chars, loss_hash.hexdigest(), size, tokens, masked))

        def table():
            names = [f.split()[0] for f in DIGEST.split(", ")]
            kinds = [pa.string() if "sha256" in n else pa.int64() for n in names]
            columns = list(zip(*done, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            ids, loss = batch.column("ids"), batch.column("loss")
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            mask = loss.flatten().to_numpy(zero_copy_only=False)
            cut = np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))))
            for i, conv in enumerate(batch.column("conv_id").to_pylist()):
                if none or conv != key:
                    close()
                    key, none = conv, False
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                part = slice(cut[i], cut[i + 1])
                role, text, learned, size = chat.read_turn(flat[part], mask[part])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += size
                state[5] += int(cut[i + 1] - cut[i])
                state[6] += int(mask[part].sum())
            if done:
                yield table()
                done.clear()
        close()
        if done:
            yield table()

    return in_arrow(ordered, run, DIGEST)
