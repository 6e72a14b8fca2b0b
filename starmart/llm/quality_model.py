"""Quality classifier: interpolated modified Kneser-Ney character n-grams.

One model per language is trained on the trusted texts (labelled quality 1,
not toxic), and one more for each of ``FOLDS`` folds of the labels, without the
fold's texts: the counts of a fold are subtracted from those of all. Labelled
documents are scored by the model without their fold, others by that of all
texts, so every trusted text sets the threshold and none by a model that knows
it. Counting is distributed: tasks count their own n-grams, counts are summed by
shuffle, and continuation counts, discounts and back-off weights are joins and
groupings of the count tables. Every distinct n-gram of the documents is then
looked up by joins with the sharded count tables, which gives one table of
log-probabilities for what the documents hold; documents are scored against it
shard by shard (``SHARD_ROWS``, so that what a task holds is bounded).

A document is rejected if its perplexity is over its language's threshold:

* with ``RESOLVED`` trusted texts or more, their ``QUANTILE``;
* with fewer, too few to resolve it, the median of their log-perplexities plus
  the ``QUANTILE`` of all trusted texts' distances from their language's median,
  in units of the language's spread (upper quartile less median);
* with fewer than ``OWN_TEXTS``, or none, a model of its own would know too
  little: its documents are scored by the pooled model of all languages'
  trusted texts. The threshold is their own median plus so many of their own
  spreads as the trusted texts' ``QUANTILE`` is under the pooled models. So a rare language isn't
  rejected for being unlike the others, but its outliers are.

A few toxic words hardly move a perplexity, nor are they the oddest words of a
text: addresses and keys are odder. So a second model of each kind is trained on
the texts labelled toxic, and a document's contrast is the largest logarithm of the
ratio of both models' probabilities over ``WINDOW`` characters. A document is
rejected too if its contrast is over the threshold, set in the same way by the
trusted texts. Without texts labelled toxic in a language, there is none.

Characters are folded into ``SYMBOLS`` symbols: code points below 0x530 as they
are, others by remainder, so that an n-gram is an integer of 12 bits a symbol.

Defined results: null and empty texts have no perplexity and are accepted, as is
everything if no trusted text is left to score another one with; a null
language is a language of its own; repeated rows are scored and returned each;
a document with several labels is trusted only if all of them are good.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import discard, in_arrow, materialize, mix

ORDER = 5
BITS = 12
PAD = 0xFFF
SYMBOLS = 0x530 + 2048
#: N-grams in a shard of the score table, which passes through the driver:
#: 24 bytes each there.
SHARD_ROWS = 1_000_000
#: Shards that a task holds at once: 16 bytes an n-gram, in half-empty tables.
SHARDS_HELD = 4
QUANTILE = 0.99
FOLDS = 3
#: Slices of the documents that are joined with their labels one by one.
SLICES = 4
#: For n-grams whose contexts leave nothing to others.
LEAST_P = 1e-12
#: Trusted texts of a language that resolve the quantile by themselves.
RESOLVED = 100
#: Trusted texts of a language that make a model of its own.
OWN_TEXTS = 20
#: Spread of logarithms that a language has at least; copies have none.
LEAST_SPREAD = 0.02
#: Model of all languages, and what stands before a fold that a model is without.
POOLED, WITHOUT = "\x03", "\x01"
#: What stands before the name of a model of toxic texts.
TOXIC = "\x02"
#: Characters of the window that contrasts are taken over.
WINDOW = 14
_CHUNK = 1 << 21
#: N-grams that a task counts before it gives them away: 16 bytes each.
_HELD = 1 << 21


def grams(text: str) -> np.ndarray:
    """The n-grams of a text, one ending at each character, padded in front."""
    char = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    symbol = np.where(char < 0x530, char, 0x530 + char % 2048)
    symbol = np.concatenate((np.full(ORDER - 1, PAD, np.int64), symbol))
    out = np.zeros(len(char), np.int64)
    for j in range(ORDER):
        out = out << BITS | symbol[j:j + len(char)]
    return out


def _summed(tallies: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, sorted, and the sums of their counts in all tallies."""
    gram, n = (np.concatenate(c) for c in zip(*tallies, strict=True))
    order = np.argsort(gram, kind="stable")
    gram, n = gram[order], n[order]
    first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.empty(0, np.int64)
    return gram[first], np.add.reduceat(n, first) if len(gram) else n


def _packed(gram: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted n-grams and their counts in few bytes: the steps between the
    n-grams, and the counts, each compressed with bytes of a kind side by side."""
    planes = [np.diff(gram, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T, n.astype(np.int64).view(np.uint8).reshape(-1, 8).T]
    return pa.compress(np.ascontiguousarray(np.concatenate(planes)).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(data, 16 * size, codec="zstd", asbytes=True), np.uint8).reshape(16, size)
    step, n = (np.ascontiguousarray(part.T).view(np.int64).reshape(-1) for part in (planes[:8], planes[8:]))
    return np.cumsum(step), n


def _tallies(docs: DataFrame) -> DataFrame:
    """(lot, packed): n-grams of all texts and how often they are met, packed by
    lots, of which each shuffle partition has one; what starts with the same
    symbols is of one lot. A task gives one row for each lot, unless it meets
    more than ``_HELD`` different n-grams."""
    lots = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    kind = pa.list_(pa.struct([("lang", pa.string()), ("size", pa.int64()), ("grams", pa.binary())]))

    def run(batches):
        fresh: dict[str, list[np.ndarray]] = {}
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        size = 0

        def count():
            for lang, parts in fresh.items():
                new = np.unique(np.concatenate(parts), return_counts=True)
                held[lang] = _summed([held[lang], new]) if lang in held else new
            fresh.clear()

        def flush():
            made: dict[int, list[dict]] = {}
            for lang, (gram, n) in held.items():
                lot = (mix((gram >> 2 * BITS).view(np.uint64)) % np.uint64(lots)).astype(np.int64)
                order = np.argsort(lot, kind="stable")
                lot, gram, n = lot[order], gram[order], n[order]
                own, first = np.unique(lot, return_index=True)
                for at, i, j in zip(own.tolist(), first.tolist(), [*first[1:].tolist(), len(lot)], strict=True):
                    made.setdefault(at, []).append({"lang": lang, "size": j - i, "grams": _packed(gram[i:j], n[i:j])})
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int64()), pa.array(list(made.values()), kind)], names=["lot", "packed"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text:
                    fresh.setdefault(lang, []).append(grams(text))
                    size += len(text)
                    if size >= _CHUNK:
                        count()
                        size = 0
                        if sum(len(gram) for gram, _ in held.values()) >= _HELD:
                            yield from flush()
        count()
        yield from flush()

    return in_arrow(docs.select("lang", "text"), run, "lot long, packed array<struct<lang: string, size: long, grams: binary>>")


def _merged(tallies: DataFrame, cuts) -> DataFrame:
    """(lang, gram, n): the rows that ``cuts`` makes of the sums of each lot, a
    dictionary from the names in the tallies to their n-grams and counts."""

    def run(table: pa.Table) -> pa.Table:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        parts = table.column("packed").combine_chunks().flatten()
        names = parts.field("lang").to_pylist()
        for lang in sorted(set(names)):
            own, size = [], 0
            for i in [i for i, name in enumerate(names) if name == lang]:
                own.append(_unpacked(parts[i]["grams"].as_py(), parts[i]["size"].as_py()))
                size += len(own[-1][0])
                if size >= _HELD:
                    own, size = [_summed(own)], 0
            sums[lang] = _summed(own)
        made = list(cuts(sums))
        return pa.table({
            "lang": pa.concat_arrays([pa.array([name] * len(g), pa.string()) for name, g, _ in made] or [pa.array([], pa.string())]),
            "gram": pa.array(np.concatenate([g for _, g, _ in made] or [np.empty(0, np.int64)])),
            "n": pa.array(np.concatenate([n for _, _, n in made] or [np.empty(0, np.int64)]))})

    return tallies.groupBy("lot").applyInArrow(run, "lang string, gram long, n long")


def _languages(docs: DataFrame, own: list[str] | tuple = ()) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.coalesce("lang", F.lit("")).alias("lang"), *own)


def trusted_ids(labels: DataFrame, out: int = 0) -> DataFrame:
    """doc_id, fold, and whether it is held out of the model without fold ``out``."""
    good = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")).where("quality = 1 AND toxic = 0")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")
    return good.select("doc_id", fold.alias("fold"), (fold == out).alias("held"))


def toxic_ids(labels: DataFrame) -> DataFrame:
    """doc_id and fold of what a label calls toxic."""
    bad = labels.where("toxic = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return bad.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"))


def marked(docs: DataFrame, labels: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, text, lang, fold, toxic of every document row, and its column
    ``row`` if named; fold and toxic are null unless the document is trusted or
    toxic."""
    own = [row] if row else []
    rows = _languages(docs, own)
    ids = (trusted_ids(labels).select("doc_id", "fold", F.lit(False).alias("toxic"))
           .unionByName(toxic_ids(labels).withColumn("toxic", F.lit(True))))
    known = rows.where("doc_id IS NOT NULL").join(ids, "doc_id", "left").select("doc_id", "text", "lang", *own, "fold", "toxic")
    nulls = (F.lit(None).cast(t).alias(c) for c, t in (("fold", "int"), ("toxic", "boolean")))
    return known.unionByName(rows.where("doc_id IS NULL").select("*", *nulls))


def _marked_slices(docs: DataFrame, labels: DataFrame, row: str | None = None) -> list[DataFrame]:
    """The rows of :func:`marked`, written slice by slice of the doc_ids: texts
    meet their labels by shuffle, and so only a slice of them is on disk twice."""
    own = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(SLICES))
    return [materialize(marked(docs.where(own == k), labels.where(own == k), row), "marked") for k in range(SLICES)]


def _fold_counts(learned: DataFrame) -> DataFrame:
    """(lang, gram, n) of all texts of a language, and of all but those of each fold."""
    keyed = learned.select(F.concat("lang", F.col("fold").cast("string")).alias("lang"), "text")

    def cuts(sums):
        nothing = np.empty(0, np.int64)
        for lang in sorted({name[:-1] for name in sums}):
            folds = [sums.get(f"{lang}{f}", (nothing, nothing)) for f in range(FOLDS)]
            gram, n = _summed(folds)
            yield lang, gram, n
            for f, (own, m) in enumerate(folds):
                rest = n.copy()
                rest[np.searchsorted(gram, own)] -= m
                yield f"{lang}{WITHOUT}{f}", gram[rest > 0], rest[rest > 0]

    return _merged(_tallies(keyed), cuts)


def train(docs: DataFrame, labels: DataFrame, out: int = 0) -> list[tuple[DataFrame, DataFrame]]:
    """The models of :func:`train_marked` without fold ``out``, by language."""
    end = f"{WITHOUT}{out}"
    return [tuple(t.where(F.col("lang").endswith(end)).withColumn("lang", F.expr(f"left(lang, length(lang) - {len(end)})")) for t in order)
            for order in train_marked(marked(docs, labels))]


def train_marked(rows: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1 on: (lang, gram, p) of seen n-grams, p fully
    interpolated, and (lang, context, back) with the back-off weights. ``lang``
    is a language, or one without a fold, of trusted or of toxic texts."""
    learned = rows.where("fold IS NOT NULL").withColumn("lang", F.when(F.col("toxic"), F.concat(F.lit(TOXIC), "lang")).otherwise(F.col("lang")))
    counts = {ORDER: materialize(_fold_counts(learned), "kn-counts")}
    for n in range(ORDER - 1, 0, -1):
        # how many different symbols stand before an n-gram
        low = F.col("gram").bitwiseAND(F.lit((1 << BITS * n) - 1))
        counts[n] = materialize(counts[n + 1].groupBy("lang", low.alias("gram")).agg(F.count("*").alias("n")), "kn-counts")
    out: list[tuple[DataFrame, DataFrame]] = []
    for n in range(1, ORDER + 1):
        of = [F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]
        y = F.expr("try_divide(n1, n1 + 2 * n2)")
        d = {i: i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")) for i in (1, 2, 3)}
        discounts = F.broadcast(materialize(counts[n].groupBy("lang").agg(*of).select("lang", *(
            F.when(d[i].isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(float(i)), d[i]))).otherwise(0.5).alias(f"d{i}") for i in (1, 2, 3))), "kn-discounts"))  # a row for each language
        # shuffles carry counts, which are small; discounts come in behind them
        contexts = (counts[n].groupBy("lang", F.shiftright("gram", BITS).alias("context"))
                    .agg(F.sum("n").alias("total"), F.count(F.when(F.col("n") == 1, 1)).alias("c1"), F.count(F.when(F.col("n") == 2, 1)).alias("c2"), F.count(F.when(F.col("n") > 2, 1)).alias("c3"))
                    .join(discounts, "lang").select("lang", "context", "total", F.expr("(c1 * d1 + c2 * d2 + c3 * d3) / total").alias("back")))
        contexts = materialize(contexts, "kn-back")
        of = contexts.select(F.col("lang").alias("l"), F.col("context").alias("c"), "total", "back")
        seen = (counts[n].join(of, (F.col("lang") == F.col("l")) & (F.shiftright("gram", BITS) == F.col("c")))
                .select("lang", "gram", "n", "total", "back"))
        if n > 1:
            below = out[-1][0].select(F.col("lang").alias("l"), F.col("gram").alias("low"), F.col("p").alias("q"))
            low = F.col("gram").bitwiseAND(F.lit((1 << BITS * (n - 1)) - 1))
            seen = (seen.join(below, (F.col("lang") == F.col("l")) & (low == F.col("low")))
                    .select("lang", "gram", "n", "total", (F.col("back") * F.col("q")).alias("rest")))
        else:
            seen = seen.withColumn("rest", F.col("back") / SYMBOLS)
        own = F.expr("(n - CASE n WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END) / total")
        seen = seen.join(discounts, "lang").select("lang", "gram", (own + F.col("rest")).alias("p"))
        out.append((materialize(seen, "kn-seen"), contexts.drop("total")))
        out[-1][1].scratch = contexts.scratch
        discard(counts[n])
    return out


def gram_scores(docs: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(lang, gram, logp, contrast) of every distinct n-gram of the documents
    whose language has a model, and by how much the toxic model's is over."""
    return _contrasts(_gram_logps(docs, model))


def _gram_logps(docs: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(lang, gram, logp) of every distinct n-gram of the documents, by their
    language's model and the toxic one: the longest seen ending, times the
    back-off weights of the contexts above it."""
    rows = _merged(_tallies(_languages(docs)), lambda sums: ((lang, gram, n) for lang, (gram, n) in sums.items())).select("lang", "gram")
    rows = rows.select(F.explode(F.array("lang", F.concat(F.lit(TOXIC), "lang"))).alias("lang"), "gram")
    rows = rows.join(F.broadcast(model[0][1].select("lang").distinct()), "lang", "left_semi")
    rows = materialize(rows.withColumn("weight", F.lit(1.0)), "kn-open")
    parts, held = [], [rows]
    for n in range(ORDER, 0, -1):
        seen, back = model[n - 1]
        low = F.col("gram").bitwiseAND(F.lit((1 << BITS * n) - 1))
        seen = seen.select(F.col("lang").alias("l"), F.col("gram").alias("low"), "p")
        tried = materialize(rows.join(seen, (F.col("lang") == F.col("l")) & (low == F.col("low")), "left").select("lang", "gram", "weight", "p"), "kn-tried")
        held.append(tried)
        parts.append(tried.where("p IS NOT NULL").select("lang", "gram", F.log(F.greatest(F.col("weight") * F.col("p"), F.lit(LEAST_P))).alias("logp")))
        back = back.select(F.col("lang").alias("l"), F.col("context").alias("c"), "back")
        rows = (tried.where("p IS NULL").join(back, (F.col("lang") == F.col("l")) & (F.shiftright(low, BITS) == F.col("c")), "left")
                .select("lang", "gram", (F.col("weight") * F.coalesce("back", F.lit(1.0))).alias("weight")))
    parts.append(rows.select("lang", "gram", F.log(F.greatest(F.col("weight") / SYMBOLS, F.lit(LEAST_P))).alias("logp")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    out = materialize(out, "kn-logp")
    discard(*held)
    return out


def _contrasts(out: DataFrame) -> DataFrame:
    toxic = out.where(F.col("lang").startswith(TOXIC)).select(F.expr("substring(lang, 2)").alias("lang"), "gram", F.col("logp").alias("other"))
    own = out.where(~F.col("lang").startswith(TOXIC))
    scores = materialize(own.join(toxic, ["lang", "gram"], "left").select("lang", "gram", "logp", (F.col("other") - F.col("logp")).alias("contrast")), "kn-scores")
    discard(out)
    return scores


class Lookup:
    """An open-addressing table from n-grams to log-probabilities and contrasts."""

    def __init__(self, gram: np.ndarray, value: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(2 * len(gram) + 1))))
        self.gram = np.full(1 << self.bits, -1, np.int64)
        self.value = np.zeros((1 << self.bits, 2), np.float32)
        slot, left = self._slot(gram), np.arange(len(gram))
        while len(left):
            free = self.gram[slot[left]] == -1
            self.gram[slot[left][free]] = gram[left][free]  # of several, the last one stays
            won = self.gram[slot[left]] == gram[left]
            self.value[slot[left][won]] = value[left][won]
            left = left[~won]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, gram: np.ndarray) -> np.ndarray:
        mixed = gram.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def values(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each n-gram's values, 0 if the table lacks it, and whether it has it."""
        out, met = np.zeros((len(gram), 2), np.float32), np.zeros(len(gram), bool)
        slot, left = self._slot(gram), np.arange(len(gram))
        while len(left):
            at = self.gram[slot]
            hit = at == gram[left]
            out[left[hit]] = self.value[slot[hit]]
            met[left[hit]] = True
            on = ~hit & (at != -1)
            left, slot = left[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out, met


def perplexities(docs: DataFrame, scores: DataFrame) -> DataFrame:
    """doc_id, lang and perplexity of each document row."""
    rows = _languages(docs)
    return judged(rows.withColumn("model", F.col("lang")), scores).drop("model", "contrast")


def judged(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """``rows`` with the perplexity and contrast of their texts under ``model``,
    without the texts.

    A task goes once through its texts. It holds the n-grams of so many
    characters (``_CHUNK``) and one shard of the scores after the other."""
    spark = rows.sparkSession
    shards = max(1, -(-scores.count() // SHARD_ROWS))
    parts = []
    slim = scores.select("lang", "gram", *(F.col(c).cast("float").alias(c) for c in ("logp", "contrast")))
    for shard in range(shards):
        own = slim.where(F.pmod(F.xxhash64("gram"), F.lit(shards)) == shard).toArrow()  # SHARD_ROWS rows
        columns = {lang: _columns(own, lang) for lang in own.column("lang").unique().to_pylist()}
        del own
        parts.append(spark.sparkContext.broadcast(columns))
        del columns
    groups = [parts[at:at + SHARDS_HELD] for at in range(0, shards, SHARDS_HELD)]
    kept = [c for c in rows.columns if c not in ("text", "model")]

    def run(batches):
        held = {}

        def tables(group):
            if group not in held:
                held.clear()
                found: dict[str, list] = {}
                for part in groups[group]:
                    for lang, columns in part.value.items():
                        found.setdefault(lang, []).append(columns)
                    vars(part).pop("_value", None)  # read again from its file if needed
                held[group] = {lang: Lookup(*(np.concatenate(c) for c in zip(*of, strict=True))) for lang, of in found.items()}
            return held[group]

        for batch in batches:
            models, texts = batch.column("model").to_pylist(), batch.column("text").to_pylist()
            found: list[float | None] = [None] * len(texts)
            highest: list[float | None] = [None] * len(texts)
            for some in _chunks(texts):
                by_model: dict[str, list[int]] = {}
                for i in some:
                    if texts[i]:
                        by_model.setdefault(models[i], []).append(i)
                gram = {m: [grams(texts[i]) for i in of] for m, of in by_model.items()}
                gram = {m: (np.concatenate(g), np.cumsum([0, *map(len, g)])) for m, g in gram.items()}
                logp = {m: np.zeros((len(g), 2), np.float64) for m, (g, _) in gram.items()}
                met = {m: np.zeros(len(g), bool) for m, (g, _) in gram.items()}
                for group in range(len(groups)):
                    for m, (g, _) in gram.items():
                        if m in tables(group):
                            value, has = tables(group)[m].values(g)
                            logp[m] += value
                            met[m] |= has
                for m, of in by_model.items():
                    ends = gram[m][1]
                    total, n = np.add.reduceat(logp[m][:, 0], ends[:-1]), np.add.reduceat(met[m], ends[:-1], dtype=np.int64)
                    for i, a, b in zip(of, total.tolist(), n.tolist(), strict=True):
                        found[i] = float(np.exp(-a / b)) if b else None
                    for i, a, b in zip(of, ends[:-1], ends[1:], strict=True):
                        run_sum = np.concatenate(([0.0], np.cumsum(logp[m][a:b, 1])))
                        most = (run_sum[WINDOW:] - run_sum[:-WINDOW]).max() if b - a > WINDOW else run_sum[-1]
                        highest[i] = float(most) if found[i] is not None and not np.isnan(most) else None
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*kept, "model")), pa.array(found, pa.float64()), pa.array(highest, pa.float64())],
                                             names=[*kept, "model", "perplexity", "contrast"])

    schema = ", ".join(f"{c} {t}" for c, t in rows.select(*kept, "model").dtypes)
    return in_arrow(rows.select(*kept, "model", "text"), run, f"{schema}, perplexity double, contrast double")


def _chunks(texts: list):
    """Runs of row numbers, each of at most ``_CHUNK`` characters or one text."""
    some, size = [], 0
    for i, text in enumerate(texts):
        if some and size + len(text or "") > _CHUNK:
            yield some
            some, size = [], 0
        some.append(i)
        size += len(text or "")
    if some:
        yield some


def _columns(table: pa.Table, lang: str) -> tuple[np.ndarray, np.ndarray]:
    import pyarrow.compute as pc

    rows = table.filter(pc.equal(table.column("lang"), lang))
    return rows.column("gram").to_numpy(), np.stack([rows.column(c).to_numpy() for c in ("logp", "contrast")], axis=1)


def _modelled(rows: DataFrame) -> DataFrame:
    """``rows`` with ``base``, the language whose models score them, or the pool.
    If a language needs the pool, trusted texts of the others are added to it
    once more, marked as ``extra``."""
    texts = rows.groupBy("lang").agg(F.count(F.when(~F.col("toxic") & (F.length("text") > 0), 1)).alias("n"))
    texts = materialize(texts.select("lang", (F.col("n") >= OWN_TEXTS).alias("own")), "languages")
    rows = rows.join(F.broadcast(texts), "lang")  # a row for each language
    out = rows.withColumn("base", F.when(F.col("own"), F.col("lang")).otherwise(POOLED)).withColumn("extra", F.lit(False))
    if not texts.where("NOT own").isEmpty():
        out = out.unionByName(rows.where("own AND fold IS NOT NULL").withColumn("base", F.lit(POOLED)).withColumn("extra", F.lit(True)))
    return out.drop("own").withColumn("model", F.concat("base", F.coalesce(F.concat(F.lit(WITHOUT), F.col("fold").cast("string")), F.lit(""))))


def thresholds(scored: DataFrame, measure: str) -> DataFrame:
    """base, lang, threshold of a measure, a logarithm, that trusted texts
    shouldn't be over; see the top of the module."""
    trusted = F.coalesce(~F.col("toxic"), F.lit(False))
    quantile = lambda x, q: F.percentile_approx(x, F.lit(q), F.lit(10_000))
    rows = scored.where(F.col(measure).isNotNull() & (trusted | (F.col("base") == POOLED)))
    centers = materialize(rows.groupBy("base", "lang").agg(
        F.count(F.when(trusted, 1)).alias("n"), quantile(F.col(measure), 0.5).alias("center"),
        F.greatest(quantile(F.col(measure), 0.75) - quantile(F.col(measure), 0.5), F.lit(LEAST_SPREAD)).alias("spread"),
        quantile(F.when(trusted, F.col(measure)), QUANTILE).alias("highest")), "centers")
    pooled = (F.col("base") == POOLED).alias("pooled")
    margins = (rows.where(trusted).join(F.broadcast(centers), ["base", "lang"])  # a row for each language
               .groupBy(pooled).agg(quantile((F.col(measure) - F.col("center")) / F.col("spread"), QUANTILE).alias("margin")))
    own = (F.col("base") != POOLED) & (F.col("n") >= RESOLVED)
    return materialize(centers.withColumn("pooled", pooled).join(F.broadcast(margins), "pooled", "left").select(
        "base", "lang", F.when(own, F.col("highest")).otherwise(F.col("center") + F.col("margin") * F.col("spread")).alias("threshold")), "thresholds")


def classify(docs: DataFrame, labels: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, lang, perplexity, threshold, contrast, contrast_threshold, accepted
    of every document row; and ``row``, a column that tells rows apart, if named."""
    slices = _marked_slices(docs, labels, row)
    rows = _modelled(reduce(DataFrame.unionByName, slices))
    by_model = rows.select("doc_id", "text", F.col("model").alias("lang"))
    model = train_marked(rows.select("text", F.col("base").alias("lang"), "fold", "toxic"))
    logps = _gram_logps(by_model, model)
    discard(*(table for order in model for table in order))
    scores = _contrasts(logps)
    scored = materialize(judged(rows, scores).withColumn("surprise", F.log("perplexity")), "perplexities")
    discard(scores, *slices)
    out = scored.where("NOT extra")
    for measure, name in (("surprise", "surprise_bar"), ("contrast", "contrast_threshold")):
        bars = thresholds(scored, measure).withColumnRenamed("threshold", name)
        out = out.join(F.broadcast(bars), ["base", "lang"], "left")  # a row for each language
    below = [F.coalesce(F.col(x) <= F.col(y), F.lit(True)) for x, y in (("surprise", "surprise_bar"), ("contrast", "contrast_threshold"))]
    return out.select("doc_id", *([row] if row else []), F.nullif("lang", F.lit("")).alias("lang"), "perplexity", F.exp("surprise_bar").alias("threshold"),
                      "contrast", "contrast_threshold", (below[0] & below[1]).alias("accepted"))
