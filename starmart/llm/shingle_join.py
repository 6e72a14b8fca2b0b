"""Exact Jaccard join of word n-gram sets in metric regions.

Sets lie in a metric space (Jaccard distance, and the symmetric difference it
is a ratio of). The join works in regions around pivots:

* **Regions.** A fixed set of pivot documents can't draw them: unrelated texts
  are at distance 1 from nearly every document, and a triangle window of twice
  the threshold around 1 copies every document into every region. So regions
  are seeded by content. The hash space is cut into more cells than two linked
  sets can differ in, so they agree in one cell that isn't empty; the least
  document of those that agree in a cell is the pivot of their region. Cells
  are dealt per size class, and documents whose size lies within the threshold
  of the class below are replicated into it (the boundary window).
* **Triangle inequality.** Each document of a region is compared with the
  pivot only. If the differences of two members to the pivot sum up to no more
  than the bound, both are linked with the pivot, so the pair needs no look.
  Others can link only if their distances to the pivot are within the bound of
  each other, and if a cell holds both besides its pivot: what meets the pivot
  in cells of two documents only has no other partner there.
* **Recursion.** Such a pair shares part of its differences to the pivot.
  Documents are replaced by those differences, rarest first, and a prefix is
  indexed, as long as partners within the bound leave room for: one for nearer
  partners, a shorter one for those as far or farther. What a region has in
  common vanishes here, and what links with the pivot is connected already, so
  only documents of different components that share an indexed difference, and
  can share as many as a link needs, are compared: first by odd sketches, which
  differ in no more bits than the sets in elements, the rest by their sets.

Exact copies fall into one class first; only one document of a class takes part,
in the search for regions too, where copies would fill cells again and again.

Defined results: a null or empty text and a text without words has no shingles
and links with nothing; a text of fewer than ``k`` words has one shingle, the
whole sequence; repeated rows are returned each; rows with a null doc_id get a
null component; different texts under one doc_id count as linked. Columns
beyond doc_id and text are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import WordHashes, discard, in_arrow, lists, materialize, mix, slices
from starmart.llm.components import components
from starmart.session import arrow_batches

#: Upper end of a size class over its lower end.
CLASS_RATIO = 1.5
#: Rows that a Python task gets and takes at once: each brings sets and prefixes.
SLICE_ROWS = 512
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles of word hashes."""
    if not len(h):
        return h
    n = max(1, len(h) - k + 1)
    total = np.full(n, np.uint64(min(len(h), k)), np.uint64)
    for j in range(min(len(h), k)):
        total = total * _ODD[0] + h[j:j + n]
    total = mix(total)
    total.sort()
    return total[np.append(True, total[1:] != total[:-1])]


class Popular:
    """Shingles that many documents hold, with their counts."""

    def __init__(self, shingle: np.ndarray, count: np.ndarray):
        order = np.argsort(shingle)
        self.shingle, self.count = shingle[order], count[order]

    def counts(self, h: np.ndarray) -> np.ndarray:
        """The count of each shingle, 1 where it isn't popular."""
        if not len(self.shingle):
            return np.ones(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.shingle, h), len(self.shingle) - 1)
        return np.where(self.shingle[at] == h, self.count[at], 1)


class Bounds:
    """Size classes and cell counts for links of ``num/den`` similarity."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def most(self, n: int) -> int:
        """The largest symmetric difference of a link whose smaller set has n elements."""
        return n * (self.den - self.num) // self.num

    def linked(self, same, total):
        """Whether sets of together ``total`` elements, ``same`` shared, link."""
        return self.den * same >= self.num * (total - same)

    def start(self, j: int) -> int:
        """Least size in class j."""
        return int(np.ceil(CLASS_RATIO ** j))

    def zones(self, n: int) -> list[tuple[int, int]]:
        """Classes in which a set of n elements may meet partners, and their
        numbers of cells: its own, and the one below if a partner fits in."""
        j = 0
        while self.start(j + 1) <= n:
            j += 1
        out = [j]
        if j and self.num * n <= self.den * (self.start(j) - 1):
            out.append(j - 1)
        return [(z, self.cells(z)) for z in out if self.most(self.start(z + 1) - 1)]

    def cells(self, z: int) -> int:
        """More cells than a link in the zone can differ in, with room for empty ones."""
        k = self.most(self.start(z + 1) - 1)
        return k + 1 + k // 10 + 2

    def prefixes(self, d: int, n: int, pivot: int, linked: bool) -> tuple[int, int]:
        """How many of its ordered differences to the pivot a set of ``n``
        elements at distance ``d`` has to show: to all its partners, and to
        those that are as far from the pivot or farther.

        A pair shares at least (d + e - k) / 2 of its differences, ``e`` being
        the partner's distance, d - k or more. A linked set only needs partners
        that aren't, and those are more than (1 - similarity) * pivot away.
        """
        k, away = self.most(n), pivot * (self.den - self.num) // self.den + 1 if linked else 0
        shares = (max(1, (d + max(least, away) - k + 1) // 2) for least in (d - k, d))
        shown, own = (max(0, d - share + 1) for share in shares)
        return shown, own

    def signatures(self, h: np.ndarray, popular: Popular) -> np.ndarray:
        """A hash of the content of every cell that isn't empty.

        Popular shingles are left out, of all sets alike, which leaves no more
        differences than before. Only where a set then fills too few cells to
        be sure of an agreeing one that isn't empty does it also deal all its
        shingles, empty cells included, and so meets the others of this kind,
        unrelated ones too. A link's smaller set is no larger than this one, so
        more filled cells than this one's own size lets it differ in are enough.
        """
        out = []
        for z, m in self.zones(len(h)):
            most = self.most(min(len(h), self.start(z + 1) - 1))
            rare = h[popular.counts(h) == 1]
            for part, kind in ((rare, 0), (h, 1)):
                cell = ((part >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
                cut = np.searchsorted(cell, np.arange(m + 1, dtype=np.uint64))
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(part * _ODD[2] + _ODD[0]))))
                full = cut[1:] > cut[:-1]
                content = np.where(full, sums[cut[1:]] - sums[cut[:-1]], _ODD[1])
                tag = (np.arange(m, dtype=np.uint64) + np.uint64((2 * z + kind) << 40)) * _ODD[3]
                made = mix(content ^ mix(tag))
                enough = full.sum() > most
                out.append(made if kind and not enough else made[full])
                if enough:
                    break
        return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


#: A shingle is popular if this share of the documents, and so many, hold it.
#: So there are at most 1 / POPULAR_SHARE times a mean set of popular ones.
POPULAR_SHARE, POPULAR_LEAST = 1 / 1000, 20
_CHUNK = 1 << 21


def _classes(docs: DataFrame, k: int) -> tuple[DataFrame, Popular]:
    """doc_id, n_shingles and rep, the least document with the same set; and
    the popular shingles. Which ones count as popular decides only how much
    is compared: counts come from chunks of 2 M shingles, those met less than
    three times in a chunk left out."""
    schema = "doc_id long, n_shingles long, key_a long, key_b long"

    def run(batches):
        hashes, held, size = WordHashes(lower=True), [], 0

        def counted():
            shingle, n = np.unique(np.concatenate(held), return_counts=True)
            shingle, n = shingle[n > 2].view(np.int64), n[n > 2]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(n), pa.int64()), pa.array(n), pa.array(shingle), pa.nulls(len(n), pa.int64())],
                names=["doc_id", "n_shingles", "key_a", "key_b"])

        for batch in slices(batches, SLICE_ROWS):
            sets = [shingles(h, k) for h in hashes.of(batch.column(1).to_pylist())]
            keys = np.array([(xxhash.xxh3_64_intdigest(s.tobytes()), xxhash.xxh3_64_intdigest(s.tobytes(), 1)) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1])],
                names=["doc_id", "n_shingles", "key_a", "key_b"])
            for s in sets:
                held.append(s)
                size += len(s)
                if size >= _CHUNK:
                    yield counted()
                    size = 0
        if held:
            yield counted()

    made = materialize(in_arrow(docs, run, schema), "set-keys")
    documents = made.where("key_b IS NOT NULL")
    full = documents.where("n_shingles > 0")
    least = full.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("rep"))
    classes = (full.join(least, ["key_a", "key_b"]).select("doc_id", "n_shingles", "rep")
               .unionByName(documents.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("rep"))))
    bar = max(POPULAR_LEAST, int(documents.count() * POPULAR_SHARE))
    often = (made.where("key_b IS NULL").groupBy("key_a").agg(F.sum("n_shingles").alias("n"))
             .where(F.col("n") >= bar).toArrow())  # bounded, see POPULAR_SHARE
    kept = materialize(classes, "set-classes")
    discard(made)
    return kept, Popular(
        often.column(0).to_numpy().view(np.uint64), often.column(1).to_numpy())


#: Bits of the filter of shared cells, at most: 16 MB, whatever the input is.
FILTER_BITS = 27


def _cell_filter(shared: DataFrame) -> tuple[int, np.ndarray]:
    """A bitmap of the shared cells. Bits are or-ed by shuffle into at most
    2 ** (FILTER_BITS - 6) words; in a full one more cells pass, none are lost."""
    bits = int(np.clip(np.ceil(np.log2(16 * max(1, shared.count()))), 16, FILTER_BITS))
    bit = F.col("cell").bitwiseAND(F.lit((1 << bits) - 1))
    words = shared.select(F.shiftright(bit, 6).alias("at"), F.expr("shiftleft(1L, cast(cell & 63 AS int))").alias("bit"))
    rows = words.groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[rows.column("at").to_numpy()] = rows.column("bit").to_numpy()
    return bits, table


def _passes(cells: np.ndarray, bits: int, table: np.ndarray) -> np.ndarray:
    """Which cells are in the bitmap."""
    return (table[(cells & ((1 << bits) - 1)) >> 6] >> (cells & 63)) & 1 == 1


def _signatures(docs: DataFrame, k: int, bounds: Bounds, popular, reps, cells=None) -> DataFrame:
    """(cell, doc_id) of the documents that may stand for their class (a bitmap
    tells, which lets few others through), or of their cells that may be shared."""

    def run(batches):
        hashes = WordHashes(lower=True)
        for batch in slices(batches, SLICE_ROWS):
            batch = batch.filter(pa.array(_passes(batch.column("own").to_numpy(), *reps.value)))
            made = [bounds.signatures(shingles(h, k), popular.value) for h in hashes.of(batch.column("text").to_pylist())]
            ids = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), [len(m) for m in made])
            flat = np.concatenate(made) if made else np.empty(0, np.int64)
            if cells is not None:
                keep = _passes(flat, *cells.value)
                flat, ids = flat[keep], ids[keep]
            for at in range(0, len(flat), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(flat[at:at + 100_000]), pa.array(ids[at:at + 100_000])], names=["cell", "doc_id"])

    return in_arrow(docs.withColumn("own", F.xxhash64("doc_id")), run, "cell long, doc_id long")


def _distinct_cells(met: DataFrame) -> DataFrame:
    """(cell, pivot, n): one cell for each group of n documents that agree in
    cells. Near copies agree in most of theirs, and each of those says the same.
    A group is told by its ends, its size and two sums of its ids' hashes."""
    own = F.xxhash64("doc_id")
    groups = met.repartition("cell").groupBy("cell").agg(  # shuffled without the sums
        F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last"), F.count("*").alias("n"),
        F.sum(F.shiftrightunsigned(own, 32)).alias("high"), F.sum(own.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low")).where("pivot < last")
    return groups.groupBy("pivot", "last", "n", "high", "low").agg(F.min("cell").alias("cell")).select("cell", "pivot", "n")


def _regions(docs: DataFrame, classes: DataFrame, k: int, bounds: Bounds, popular) -> DataFrame:
    """(pivot, doc, several): classes that agree with the pivot in a cell, and
    whether others do in one of those cells. Copies fill the cells of the least
    of their class, so one that passes the bitmap is never a pivot."""
    reps = materialize(classes.where("doc_id = rep AND n_shingles > 0").select(F.col("rep").alias("doc")).distinct(), "reps")
    passing = docs.sparkSession.sparkContext.broadcast(_cell_filter(reps.select(F.xxhash64("doc").alias("cell"))))
    shared = materialize(
        _signatures(docs, k, bounds, popular, passing).groupBy("cell").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last"))
        .where("pivot < last").select("cell"), "shared-cells")
    cells = docs.sparkSession.sparkContext.broadcast(_cell_filter(shared))
    discard(shared)
    met = materialize(_signatures(docs, k, bounds, popular, passing, cells), "met-cells")
    pairs = (met.join(_distinct_cells(met), "cell").where("doc_id > pivot")
             .groupBy("pivot", "doc_id").agg((F.max("n") > 2).alias("several")))
    out = materialize(pairs.join(reps, F.col("doc_id") == F.col("doc"), "left_semi").select("pivot", F.col("doc_id").alias("doc"), "several"), "regions")
    discard(met, reps)
    return out


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The sorted shingle hashes of the wanted documents, one row for each.
    Texts aren't shuffled: tasks drop those that a bitmap of the wanted lacks,
    and what it lets through falls to the join."""
    passing = docs.sparkSession.sparkContext.broadcast(_cell_filter(wanted.select(F.xxhash64("wanted").alias("cell"))))

    def run(batches):
        hashes = WordHashes(lower=True)
        for batch in slices(batches, SLICE_ROWS):
            batch = batch.filter(pa.array(_passes(batch.column("own").to_numpy(), *passing.value)))
            made = [shingles(h, k).view(np.int64) for h in hashes.of(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists(made, pa.int64())], names=["doc_id", "shingles"])

    met = in_arrow(docs.withColumn("own", F.xxhash64("doc_id")), run, "doc_id long, shingles array<long>")
    return met.join(wanted, F.col("doc_id") == F.col("wanted"), "left_semi").dropDuplicates(["doc_id"])


def _arrays(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    cut = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))))
    return [flat[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _with_both(pairs: DataFrame, facts: DataFrame, one: str, two: str, *more: str) -> DataFrame:
    """The pairs with the columns of ``facts`` of both documents, and ``more``."""
    columns = [c for c in facts.columns if c != "doc_id"]

    def named(name: str) -> DataFrame:
        return facts.select(F.col("doc_id").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    return pairs.join(named(two), two).join(named(one), one).select(one, two, *[f"{x}_{c}" for c in columns for x in (one, two)], *more)


#: Bits of an odd sketch.
ODD_BITS = 1024


def _odd_sketches(sets: DataFrame) -> DataFrame:
    """n, the size of each set, and for each value of the hashes' last bits
    whether an odd number of them has it."""

    def run(batches):
        for batch in slices(batches, SLICE_ROWS):
            made = _arrays(batch.column("shingles"))
            odd = [np.packbits(np.bincount((h & np.uint64(ODD_BITS - 1)).astype(np.int64), minlength=ODD_BITS) & 1).tobytes() for h in made]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(h) for h in made], pa.int32()), pa.array(odd, pa.binary())], names=["doc_id", "n", "odd"])

    return in_arrow(sets, run, "doc_id long, n int, odd binary")


def _near(pairs: DataFrame, sketches: DataFrame, bounds: Bounds) -> DataFrame:
    """The pairs whose sketches don't rule out a link. An element that one set
    lacks changes one bit, so sets differ in as many elements as bits, or more."""

    def run(batches):
        for batch in batches:
            bits, n = ([batch.column(f"{x}_{c}") for x in ("one", "two")] for c in ("odd", "n"))
            one, two = (np.frombuffer(b"".join(b.to_pylist()), np.uint64).reshape(-1, ODD_BITS // 64) for b in bits)
            total = sum(c.to_numpy().astype(np.int64) for c in n)
            least = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
            yield batch.select(["one", "two"]).filter(pa.array(bounds.linked((total - least) / 2, total)))

    return in_arrow(_with_both(pairs, sketches, "one", "two"), run, "one long, two long")


def _compare(regions: DataFrame, sets: DataFrame, bounds: Bounds, popular) -> DataFrame:
    """Each document against its pivot: linked or not, its size and distance,
    and the prefix of its differences that it shows if others may be partners
    there, with their places; ``own`` are those for partners as far or farther.
    A token stands for pivot and difference.

    Any order that all members of a region share keeps the prefix exact; this
    one puts first what few of them can share: what a document adds to the
    pivot by its count, what it lacks by how far that count falls short of the
    pivot's most popular shingle.
    """
    def run(batches):
        known = popular.value
        for batch in slices(batches, SLICE_ROWS):
            facts, token, place, own = [], [], [], []
            pivots = mix(batch.column("pivot").to_numpy(zero_copy_only=False).view(np.uint64) + _ODD[2])
            sets = (_arrays(batch.column(f"{c}_shingles")) for c in ("pivot", "doc"))
            for at, p, x, several in zip(pivots, *sets, batch.column("several").to_pylist(), strict=True):
                more, less = (np.setdiff1d(a, b, assume_unique=True) for a, b in ((x, p), (p, x)))
                is_linked, away = bool(bounds.linked(len(x) - len(more), len(x) + len(p))), len(more) + len(less)
                shown, nearer = bounds.prefixes(away, len(x), len(p), is_linked) if several else (0, 0)
                top = int(known.counts(p).max())
                order = np.concatenate((known.counts(more), top - known.counts(less)))
                tokens = np.concatenate((mix(more), mix(less ^ _ODD[1])))
                tokens = tokens[np.lexsort((tokens, order))][:shown]
                token.append(mix(tokens ^ at).view(np.int64))
                place.append(np.arange(len(tokens), dtype=np.int32))
                own.append(place[-1] < nearer)
                facts.append((is_linked, len(x), away))
            linked, n, d = (list(c) for c in zip(*facts, strict=True)) if facts else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("pivot"), batch.column("doc"), pa.array(linked, pa.bool_()), pa.array(n, pa.int32()), pa.array(d, pa.int32()),
                 lists(token, pa.int64()), lists(place, pa.int32()), lists(own, pa.bool_())],
                names=["pivot", "doc", "linked", "n", "d", "token", "place", "own"])

    return in_arrow(_with_both(regions, sets, "pivot", "doc", "several"), run,
                    "pivot long, doc long, linked boolean, n int, d int, token array<long>, place array<int>, own array<boolean>")


def _met(labelled: DataFrame) -> DataFrame:
    """Tokens (``cell``) that documents of different components show."""
    shown = labelled.select("label", F.explode(F.arrays_zip("token", "own")).alias("t"))
    return (shown.groupBy(F.col("t.token").alias("cell"))
            .agg(F.min("label").alias("a"), F.max("label").alias("b"), F.max("t.own").alias("own"))
            .where("a < b AND own").select("cell"))


def _shown(labelled: DataFrame, met) -> DataFrame:
    """One row for each token of a document that may be among those met."""

    def run(batches):
        for batch in slices(batches, SLICE_ROWS):
            tokens = batch.column("token")
            row = np.repeat(np.arange(batch.num_rows), tokens.value_lengths().to_numpy(zero_copy_only=False))
            cell = tokens.flatten().to_numpy(zero_copy_only=False)
            keep = np.flatnonzero(_passes(cell, *met.value))
            for at in range(0, len(keep), 100_000):
                part = keep[at:at + 100_000]
                facts = [batch.column(c).take(pa.array(row[part])) for c in ("doc", "n", "d", "label")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[part]), *facts, *[batch.column(c).flatten().take(pa.array(part)) for c in ("place", "own")]],
                    names=["cell", "doc", "n", "d", "label", "place", "own"])

    return in_arrow(labelled, run, "cell long, doc long, n int, d int, label long, place int, own boolean")


def _candidates(compared: DataFrame, labels: DataFrame, bounds: Bounds) -> DataFrame:
    """(one, two): documents of a region that aren't connected yet and whose
    shared difference leaves room for as many as a link needs. The nearer one
    shows it among its own."""
    labelled = compared.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select(
        "doc", "n", "d", F.coalesce("component", "doc").alias("label"), "token", "place", "own")
    met = materialize(_met(labelled), "met-tokens")
    passing = compared.sparkSession.sparkContext.broadcast(_cell_filter(met))
    rows = materialize(_shown(labelled, passing).join(met, "cell", "left_semi"), "shown-tokens")
    one, two = rows.where("own").alias("x"), rows.alias("y")
    most = f"(((x.n + y.n) * {bounds.den - bounds.num}) div {bounds.den + bounds.num})"
    fits = (f"x.label != y.label AND (x.d < y.d OR x.d = y.d AND y.own AND x.doc < y.doc) AND y.d - x.d <= {most}"
            f" AND {bounds.num} * greatest(x.n, y.n) <= {bounds.den} * least(x.n, y.n)"
            f" AND 2 * least(x.d - x.place, y.d - y.place) >= x.d + y.d - {most}")
    pairs = (one.join(two, (F.col("x.cell") == F.col("y.cell")) & F.expr(fits))
             .select(F.least("x.doc", "y.doc").alias("one"), F.greatest("x.doc", "y.doc").alias("two")).distinct())
    out = materialize(pairs, "pairs")
    discard(met, rows)
    return out


def _verify(pairs: DataFrame, sets: DataFrame, bounds: Bounds) -> DataFrame:
    """The links among the pairs."""

    def run(batches):
        for batch in slices(batches, SLICE_ROWS):
            keep = [bool(bounds.linked(len(np.intersect1d(a, b, assume_unique=True)), len(a) + len(b)))
                    for a, b in zip(*(_arrays(batch.column(f"{c}_shingles")) for c in ("one", "two")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("two").filter(pa.array(keep, pa.bool_())), batch.column("one").filter(pa.array(keep, pa.bool_()))], names=["a", "b"])

    return in_arrow(_with_both(pairs, sets, "one", "two"), run, "a long, b long")


def similar_components(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id of every row: documents link
    whose k-word shingle sets have a Jaccard similarity of num/den or more."""
    with arrow_batches(docs.sparkSession, SLICE_ROWS):
        return _similar_components(docs, k, num, den)


def _similar_components(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    known, bounds = docs.where("doc_id IS NOT NULL"), Bounds(num, den)
    classes, often = _classes(docs, k)
    popular = docs.sparkSession.sparkContext.broadcast(often)
    regions = _regions(known, classes, k, bounds, popular)
    wanted = materialize(regions.select(F.explode(F.array("pivot", "doc")).alias("wanted")).distinct(), "wanted")
    sets = materialize(_sets(known, wanted, k), "region-sets")
    compared = materialize(_compare(regions, sets, bounds, popular), "compared")
    discard(regions, wanted)
    # rows of one id with different texts count as linked
    twice = classes.where("doc_id != rep").join(
        classes.where("doc_id = rep").select(F.col("doc_id").alias("own")), F.col("doc_id") == F.col("own"), "left_semi")
    links = materialize(compared.where("linked").select(F.col("doc").alias("a"), F.col("pivot").alias("b"))
                        .unionByName(twice.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))), "pivot-links")
    pairs = _candidates(compared, components(links), bounds)
    discard(compared)
    sketches = materialize(_odd_sketches(sets), "odd-sketches")
    near = materialize(_near(pairs, sketches, bounds), "near-pairs")
    discard(pairs, sketches)
    found = materialize(_verify(near, sets, bounds), "pair-links")
    discard(near, sets)
    of = components(links.unionByName(found))
    return (classes.join(of, F.col("rep") == F.col("node"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"), F.col("rep").alias("class_id")))
