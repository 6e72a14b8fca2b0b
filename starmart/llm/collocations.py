"""Phrase collocations, counted in burstable tries.

A task counts all phrases of up to ``max_words`` words in a HAT-trie over word
numbers. Its leaves are hash containers, each for a range of prefixes: at first
one holds everything; a container that grows too large bursts in two at a first
word, or, where it holds a single first word, at a second word, and so on. At a
bound on its entries the task spills its largest containers, whole subtrees, as
runs sorted by phrase. Sampled splitters cut the order of phrases into prefix
partitions, each run goes there in compressed slices, and a partition adds up
equal phrases. A phrase stands once in a run, so no partition is hot, and a
prefix that many phrases share is cut like any other.

Every cut of a frequent phrase needs the counts of its two parts, which are
frequent themselves, so only frequent phrases are joined. Parts that a
thousandth of the cuts or more ask for (1,000 at most) are dealt over salts.

Defined results: texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
pieces into words at spaces and tabs, A-Z in lower case; a null text has no
words; a null language counts as ``und``. Everything is per language. Repeated
rows count each. Other columns are ignored. Ranks break ties by the phrase, so
they are unique. An empty table gives no rows. Scores are exact while a phrase
occurs less than 10**16 times; beyond that the query fails.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import in_arrow, materialize, mix, runs

NO_LANGUAGE = "und"
#: Bytes of texts and tokens counted at once, entries a task holds, and entries
#: of a container before it bursts.
BLOCK_BYTES, BLOCK_TOKENS, HELD_ENTRIES, CONTAINER_ENTRIES = 2 << 20, 250_000, 1_000_000, 1 << 16
#: Rows of a run in one compressed slice at most.
SLICE_ROWS = 200_000
#: Bytes of text a prefix partition, bytes of text that the splitters are sampled
#: from (about), and sampled phrases a partition (about).
PART_BYTES, SAMPLE_BYTES, SAMPLES = 2 << 20, 16 << 20, 16
#: A part is hot from this share of all cuts on; hot parts are dealt over SALTS.
HOT_SHARE, SALTS = 1000, 64
_CUTS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
_PIECE_END, _NOTHING = 0, 1
_FREE = np.int64(-1)


class Words(dict):
    """Numbers of words in the order they are met."""

    def __init__(self):
        super().__init__({b"\n": _PIECE_END, b"": _NOTHING})
        self.spelled = [b"\n", b""]

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.spelled.append(word)
        return n


class Container:
    """A hash table from packed phrases to counts, filled in batches."""

    def __init__(self, room: int = 1 << 10):
        self.size = 0
        self.keys, self.counts = np.full(room, _FREE, np.int64), np.zeros(room, np.int64)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        used = np.flatnonzero(self.keys != _FREE)
        return self.keys[used], self.counts[used]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add distinct phrases. All look at their slot at once; those that find
        another phrase there, or lose a free slot to one, go on to the next."""
        room = len(self.keys)
        if 2 * (self.size + len(keys)) > room:
            old = self.items()
            while 2 * (self.size + len(keys)) > room:
                room *= 2
            self.__init__(room)
            self.add(*old)
        slot = (mix(keys.view(np.uint64)) & np.uint64(room - 1)).astype(np.int64)
        while len(keys):
            there = self.keys[slot]
            free = there == _FREE
            self.keys[slot[free]] = keys[free]
            own = self.keys[slot] == keys
            self.counts[slot[own]] += counts[own]
            self.size += int(np.count_nonzero(own & free))
            keys, counts, slot = keys[~own], counts[~own], (slot[~own] + 1) & (room - 1)


class PhraseTrie:
    """Counts of phrases of word numbers, packed ``bits`` a word into an integer
    with the first word on top; shorter phrases end in zeros."""

    def __init__(self, max_words: int, bits: int, container: int = CONTAINER_ENTRIES):
        self.container = container
        self.shifts = [bits * k for k in range(max_words - 1, -1, -1)]
        #: each container's least prefix, in order
        self.low, self.leaves = [0], [Container()]

    @property
    def entries(self) -> int:
        return sum(c.size for c in self.leaves)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add sorted distinct phrases."""
        ends = [*np.searchsorted(keys, self.low[1:]).tolist(), len(keys)]
        full, start = [], 0
        for i, end in enumerate(ends):
            if start < end:
                self.leaves[i].add(keys[start:end], counts[start:end])
                if self.leaves[i].size > self.container:
                    full.append(i)
            start = end
        for i in reversed(full):
            self._burst(i)

    def _burst(self, i: int) -> None:
        """Cut a container at the first word near its middle, or, if all its
        phrases share that, at the next word; again while a part is too large."""
        keys, counts = self.leaves[i].items()
        order = np.argsort(keys)
        todo, low, leaves = [(keys[order], counts[order], self.low[i])], [], []
        while todo:
            keys, counts, least = todo.pop()
            cut = self._cut(keys) if len(keys) > self.container else None
            if cut is None:
                leaf = Container()
                leaf.add(keys, counts)
                low.append(least)
                leaves.append(leaf)
            else:
                at = int(np.searchsorted(keys, cut))
                todo += [(keys[at:], counts[at:], cut), (keys[:at], counts[:at], least)]
        self.low[i:i + 1], self.leaves[i:i + 1] = low, leaves

    def _cut(self, keys: np.ndarray) -> int | None:
        middle = int(keys[len(keys) // 2])
        for shift in self.shifts:
            own = middle >> shift << shift
            for cut in (own, own + (1 << shift)):
                if keys[0] < cut <= keys[-1]:
                    return cut
        return None

    def take(self, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """The largest containers, ``entries`` or more together; they go."""
        out = []
        for i in sorted(range(len(self.leaves)), key=lambda i: -self.leaves[i].size):
            if entries <= 0:
                break
            entries -= self.leaves[i].size
            out.append(self.leaves[i].items())
            self.leaves[i] = Container()
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 2


class PhraseCounter:
    """Counts the phrases of texts by language; gives back sorted runs."""

    def __init__(self, max_words: int, held: int = HELD_ENTRIES, container: int = CONTAINER_ENTRIES):
        self.max_words, self.held, self.container = max_words, held, container
        self.bits = 63 // max_words
        self.shifts = [self.bits * k for k in range(max_words - 1, -1, -1)]
        self.words = Words()
        self.tries: dict[str, PhraseTrie] = {}
        self.sorted: tuple[int, list[bytes], np.ndarray] = (0, [], np.empty(0, np.int64))

    def blocks(self, data: bytes):
        """(tokens, number of them that start a phrase): runs of the words of
        texts with the next words, which phrases from the run may reach into."""
        tokens = data.lower().translate(_CUTS).replace(b"\n", b" \n ").split(b" ")
        step = min(BLOCK_TOKENS, 1 << (self.bits - 1))  # a block's words can all be new
        for first in range(0, len(tokens), step):
            last = end = min(first + step, len(tokens))
            more = self.max_words - 1
            while more and end < len(tokens) and tokens[end] != b"\n":
                more -= tokens[end] != b""
                end += 1
            yield tokens[first:end], last - first

    def packed(self, tokens: list[bytes], starts: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct phrases that start in the first tokens, and their counts."""
        w = np.array(list(map(self.words.__getitem__, tokens)), np.int64)
        inside = np.arange(len(w)) < starts
        w, inside = w[w != _NOTHING], inside[w != _NOTHING]
        found = []
        key = np.zeros(len(w), np.int64)
        for k in range(self.max_words):
            n = len(w) - k
            if n <= 0:
                break
            inside = inside[:n] & (w[k:] != _PIECE_END)
            key = key[:n] | w[k:] << (self.bits * (self.max_words - 1 - k))
            found.append(key[inside])
        return np.unique(np.concatenate(found), return_counts=True) if found else (key, key)

    def add(self, lang: str, data: bytes):
        """Count some texts of a language (``\n`` between them); runs that had
        to go come back."""
        for tokens, starts in self.blocks(data):
            if len(self.words) + len(tokens) >= min(1 << self.bits, self.held + BLOCK_TOKENS):
                yield from self.finish()  # word numbers may run out
            if lang not in self.tries:
                self.tries[lang] = PhraseTrie(self.max_words, self.bits, self.container)
            self.tries[lang].add(*self.packed(tokens, starts))
            yield from self._relieve()

    def _relieve(self):
        """Spill the largest containers while there are too many entries."""
        over = sum(t.entries for t in self.tries.values()) - self.held
        if over > 0:
            over += self.held // 2
            for lang, t in sorted(self.tries.items(), key=lambda x: -x[1].entries):
                if over <= 0:
                    break
                keys, counts = t.take(over)
                over -= len(keys)
                yield self.run(lang, keys, counts)

    def finish(self):
        for lang, t in self.tries.items():
            if t.entries:
                yield self.run(lang, *t.take(t.entries))
        self.tries.clear()
        self.words = Words()

    def ranks(self) -> tuple[list[bytes], np.ndarray]:
        """The words in order, and the place of each word number in it, from 1."""
        spelled = self.words.spelled
        if self.sorted[0] is not spelled or len(self.sorted[2]) != len(spelled):
            order = sorted(range(2, len(spelled)), key=spelled.__getitem__)
            rank = np.zeros(len(spelled), np.int64)
            rank[order] = np.arange(1, len(order) + 1)
            self.sorted = (spelled, [spelled[i] for i in order], rank)
        return self.sorted[1:]

    def run(self, lang: str, keys: np.ndarray, counts: np.ndarray) -> "Run":
        words, rank = self.ranks()
        mask, ranked = (1 << self.bits) - 1, np.zeros(len(keys), np.int64)
        for s in self.shifts:
            ranked |= rank[keys >> s & mask] << s
        order = np.argsort(ranked)
        return Run(lang, words, ranked[order], counts[order], self.shifts, mask)


class Run:
    """Phrases in the order of their words, with counts."""

    def __init__(self, lang: str, words: list[bytes], keys: np.ndarray, counts: np.ndarray, shifts: list[int], mask: int):
        self.lang, self.words, self.keys, self.counts, self.shifts, self.mask = lang, words, keys, counts, shifts, mask
        self.known = pa.array(words, pa.binary())

    def least_key(self, phrase: list[bytes]) -> int:
        """Where a phrase stands, or would stand, among the keys."""
        key = 0
        for shift, word in zip(self.shifts, phrase, strict=False):
            at = bisect_left(self.words, word)
            key |= at + 1 << shift
            if at == len(self.words) or self.words[at] != word:
                break
        return key

    def phrase(self, i: int) -> list[bytes]:
        return [self.words[p - 1] for p in (int(self.keys[i]) >> s & self.mask for s in self.shifts) if p]

    def table(self, start: int, end: int) -> pa.Table:
        part = [self.keys[start:end] >> s & self.mask for s in self.shifts]
        spelled = [self.known.take(pa.array(p - 1, mask=p == 0)) for p in part]
        phrase = pc.binary_join_element_wise(*spelled, pa.scalar(b" ", pa.binary()), null_handling="skip") if len(part) > 1 else spelled[0]
        return pa.table({"lang": pa.DictionaryArray.from_arrays(np.zeros(end - start, np.int8), [self.lang]), "phrase": phrase,
                         "words": pa.array(sum((p > 0).astype(np.int32) for p in part), pa.int32()), "n": pa.array(self.counts[start:end], pa.int64())})

    def slices(self, splitters: list[tuple[str, list[bytes]]]):
        """(prefix partition, rows) of the run."""
        own = bisect_left(splitters, self.lang, key=lambda x: x[0]), bisect_right(splitters, self.lang, key=lambda x: x[0])
        cuts = np.searchsorted(self.keys, [self.least_key(p) for _, p in splitters[slice(*own)]]).tolist()
        for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(self.keys)], strict=True)):
            if a < b:
                yield own[0] + i, self.table(a, b)


def _packed_slice(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _counted(batches, counter: PhraseCounter):
    """The runs of all texts of (language, text) batches."""
    for batch in batches:
        texts: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for lang, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not value:
                continue
            texts.setdefault(lang, []).append(value.encode())
            size[lang] = size.get(lang, 0) + len(texts[lang][-1])
            if size[lang] > BLOCK_BYTES:
                yield from counter.add(lang, b"\n".join(texts.pop(lang)))
                size[lang] = 0
        for lang, group in texts.items():
            yield from counter.add(lang, b"\n".join(group))
    yield from counter.finish()


def _splitters(rows: DataFrame, max_words: int, n_bytes: int, parts: int) -> list[tuple[str, list[bytes]]]:
    """Phrases that cut the order of phrases into even partitions: from a sample
    of one text in ``every`` (by hash), about SAMPLES phrases a partition."""
    if parts < 2:
        return []
    every = max(1, n_bytes // SAMPLE_BYTES)
    step = max(1, n_bytes // every // (4 * SAMPLES * parts))

    def run(batches):
        for found in _counted(batches, PhraseCounter(max_words)):
            picked = [found.phrase(i) for i in range(step // 2, len(found.keys), step)]
            yield pa.RecordBatch.from_arrays([pa.array([found.lang] * len(picked), pa.string()), pa.array(picked, pa.list_(pa.binary()))], names=["lang", "words"])

    sample = in_arrow(rows.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0), run, "lang string, words array<binary>").collect()
    keys = sorted((r["lang"], [bytes(w) for w in r["words"]]) for r in sample)
    parts = min(parts, len(keys))
    cuts = [keys[len(keys) * i // parts] for i in range(1, parts)]
    return [c for i, c in enumerate(cuts) if not i or c != cuts[i - 1]]


def phrase_counts(docs: DataFrame, max_words: int, least: int, lang: str = "lang", text: str = "text", held: int = HELD_ENTRIES) -> DataFrame:
    """lang, phrase, words, a: the phrases that occur ``least`` times or more,
    and rows without a phrase whose ``a`` add up to the words of a language."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).alias("text"))
    n_bytes = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    splitters = _splitters(rows, max_words, n_bytes, -(-n_bytes // PART_BYTES))

    def run(batches):
        for found in _counted(batches, PhraseCounter(max_words, held)):
            for part, table in found.slices(splitters):
                for at in range(0, len(table), SLICE_ROWS):
                    packed = _packed_slice(table.slice(at, SLICE_ROWS))
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed], pa.binary())], names=["part", "run"])

    def merge(table: pa.Table) -> pa.Table:
        own = [pa.ipc.open_stream(r.as_buffer()).read_all() for r in table.column("run").combine_chunks()]
        whole = pa.concat_tables([t.set_column(0, "lang", t.column("lang").cast(pa.string())) for t in own])
        totals = whole.filter(pc.equal(whole.column("words"), 1)).group_by("lang").aggregate([("n", "sum")])
        found = whole.group_by(["lang", "phrase", "words"]).aggregate([("n", "sum")])
        found = found.filter(pc.greater_equal(found.column("n_sum"), least))
        out = pa.table({"lang": found.column("lang"), "phrase": found.column("phrase").cast(pa.string()), "words": found.column("words"), "a": found.column("n_sum")})
        n = len(totals)
        return pa.concat_tables([out, pa.table({"lang": totals.column("lang"), "phrase": pa.nulls(n, pa.string()), "words": pa.array([0] * n, pa.int32()), "a": totals.column("n_sum")})])

    return in_arrow(rows, run, "part int, run binary").groupBy("part").applyInArrow(merge, "lang string, phrase string, words int, a long")


def _lookups(candidates: DataFrame, frequent: DataFrame, max_words: int) -> DataFrame:
    """lang, phrase, a, cut, l, r: the counts of both parts of every cut."""
    words, cut = F.split("phrase", " "), F.col("cut")
    cuts = candidates.where("words > 1").select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    parts = cuts.select("lang", "phrase", "a", "cut", F.inline(F.array(
        F.struct(F.lit(True).alias("left"), F.array_join(F.slice(words, F.lit(1), cut), " ").alias("part")),
        F.struct(F.lit(False).alias("left"), F.array_join(F.slice(words, cut + 1, F.size(words)), " ").alias("part")))))
    asked = parts.groupBy("lang", "part").agg(F.count("*").alias("uses"))
    total = parts.count()
    # at most HOT_SHARE parts can each take a share of 1 / HOT_SHARE
    hot = F.broadcast(materialize(asked.where(F.col("uses") * HOT_SHARE >= F.lit(total)).select("lang", "part", F.lit(True).alias("hot")), "collocation-hot"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("phrase", "cut"), F.lit(SALTS))).otherwise(F.lit(0))
    asking = parts.join(hot, ["lang", "part"], "left").withColumn("salt", salt.cast("int"))
    counted = (frequent.select("lang", F.col("phrase").alias("part"), F.col("a").alias("n")).join(hot, ["lang", "part"], "left")
               .select("lang", "part", "n", F.explode(F.sequence(F.lit(0), F.when(F.col("hot"), F.lit(SALTS - 1)).otherwise(F.lit(0)))).alias("salt")))
    return (asking.join(counted, ["lang", "part", "salt"]).groupBy("lang", "phrase", "a", "cut")
            .agg(F.max(F.when(F.col("left"), F.col("n"))).alias("l"), F.max(F.when(~F.col("left"), F.col("n"))).alias("r")))


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, top: int = 2000, inside_share: int = 50,
                 lang: str = "lang", text: str = "text", held: int = HELD_ENTRIES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases.

    ``least`` is the fewest occurrences; a phrase goes when a longer one that
    holds it has ``inside_share`` per cent of its occurrences or more.
    """
    counted = materialize(phrase_counts(docs, max_words, least, lang, text, held), "collocation-counts")
    sizes = counted.where("words = 0").groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = counted.where("words > 0")
    candidates = frequent.where("words > 1")

    wide = [F.col(c).cast("decimal(38,0)") for c in ("a", "a", "l", "r")]
    scored = (_lookups(candidates, frequent, max_words)
              .withColumn("up", F.lit(1000000).cast("decimal(38,0)") * wide[0] * wide[1]).withColumn("down", wide[2] * wide[3])
              .withColumn("score", F.expr("up div down"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("least"))
              .select("lang", "phrase", "a", F.col("least.l").alias("l"), F.col("least.r").alias("r"), F.col("least.score").alias("score")))

    # every shorter phrase inside a longer candidate, with the most that holds it
    words = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda at: F.array_join(F.slice(words, at, n), " "))))
    longest = (candidates.where("words > 2").select("lang", "a", F.explode(inner).alias("inside"))
               .groupBy("lang", "inside").agg(F.max("a").alias("longer"))
               .withColumnsRenamed({"lang": "inside_lang"}))
    kept = (scored.join(longest, (F.col("lang") == F.col("inside_lang")) & (F.col("phrase") == F.col("inside")), "left")
            .where(f"longer IS NULL OR 100 * longer < {inside_share} * a"))

    # the best of each part of a language first, so that no task ranks it whole
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(shards)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
