"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import discard_path, freed_shuffles, scratch_path

#: Words of a text without case: runs of ASCII letters and digits and of
#: anything outside ASCII. The characters between words are written one by one,
#: as Java's regex looks up such a class in a table but tries ranges in turn.
#: Spark keeps the case of the words it extracts with
#: this pattern, so that A-Z alone can be lower-cased where words are compared.
CASED_WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Of a table with rows of megabytes: readers decode up to a row group at once,
#: and writers, left alone, look at a group's size after 100 rows only.
LARGE_ROWS = {"parquet.block.row.count.limit": "8"}


def materialize(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir``, with the options of Parquet, and read it back.

    Cuts the lineage at a place that every executor shares: a lost executor
    loses no rows, and later stages start from the files. The shuffle files of
    the write go with its end, as nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        df.write.options(compression="zstd", **(options or {})).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of materialized tables that nothing reads any more."""
    for table in tables:
        discard_path(table.sparkSession, table.scratch)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Have Spark carry this package to the Python workers, once an application.

    Executors need no copy of the repository: the zip goes through Spark's own
    file distribution. A package that was submitted as a zip is there already.
    """
    sc, root = spark.sparkContext, Path(__file__).parent.parent
    if sc.applicationId in _SHIPPED or not root.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="starmart-ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def in_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with this package on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(batches, rows: int):
    """The batches in parts of at most so many rows, where a row makes much."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ascii_lower(col):
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def cased_words(col):
    """The words of a text in their own case, null as no words."""
    return F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(CASED_WORD), F.lit(0))


#: Odd base of the word hash and its inverse modulo 2**64.
_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BLOCK = 1 << 19


class WordHashes:
    """64-bit hashes of the words of texts, between ASCII white space.

    Bytes are hashed in blocks: a word's hash is a difference of two running
    sums of ``value(byte) * base**place``, brought back to place 0. Blocks end
    between words, so memory follows the block size or the longest word.
    """

    def __init__(self, lower: bool):
        self.lower = lower
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, _BLOCK + 1)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                table = np.full(size, np.uint64(base), np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))

    def _block(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where words start, and the words' hashes."""
        self._grow(len(data) + 1)
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
        start, end = edge[::2], edge[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * self.up[:len(data)], out=sums[1:])
        return start, mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        """The hashes of each text's words, in order; null as no words."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        group: list[tuple[int, bytes]] = []
        size = 0

        def flush():
            nonlocal size
            if group:
                start, hashed = self._block(np.frombuffer(b"\n".join(d for _, d in group), np.uint8))
                begins = np.cumsum([0, *(len(d) + 1 for _, d in group)])
                cut = np.searchsorted(start, begins).tolist()
                for (i, _), a, b in zip(group, cut[:-1], cut[1:], strict=True):
                    found[i].append(hashed[a:b])
            group.clear()
            size = 0

        for i, text in enumerate(texts):
            data = (text or "").encode()
            data = data.lower() if self.lower else data  # of bytes: A-Z alone
            while len(data) > _BLOCK:
                at = max(data.rfind(b, 0, _BLOCK) for b in (b" ", b"\n", b"\t"))
                if at <= 0:  # a word longer than a block
                    at = next((p for p in range(_BLOCK, len(data)) if _SPACE[data[p]]), len(data))
                flush()
                group.append((i, data[:at]))
                flush()
                data = data[at + 1:]
            group.append((i, data))
            size += len(data)
            if size > _BLOCK:
                flush()
        flush()
        return [f[0] if len(f) == 1 else np.concatenate(f) if f else np.empty(0, np.uint64) for f in found]


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums and products of hashes spread evenly."""
    v = values ^ (values >> np.uint64(32))
    v = v * np.uint64(0xD6E8FEB86659FD93)
    v ^= v >> np.uint64(32)
    v = v * np.uint64(0xD6E8FEB86659FD93)
    return v ^ (v >> np.uint64(32))


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start (inclusive) and end (exclusive) of each run of equal values."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate(([0], cut)), np.concatenate((cut, [len(values)]))


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column of one array per row."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))
