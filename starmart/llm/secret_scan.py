"""Secret scan: known shapes, and character Markov models for the rest.

Native DataFrame code. Two character bigram models are trained from labelled
samples: *random* strings, which are hex and base64 renderings of SHA-256
values of the sampled documents' ids, and *ordinary* identifiers, which are
the sampled documents' words. A long token with a digit is a secret if its mean
log-likelihood ratio per character, random against ordinary, is over ``MARGIN``.

Places come from a regular expression's matches and the pieces between them:
both scan left to right without overlap, so running sums of their lengths are
the matches' places, in code points.

Defined results: null and empty texts have no spans; repeated rows are scanned
and returned each; a null doc_id is kept; a token that touches a base span adds
no span of its own. Other columns are ignored (kept by :func:`redact`).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import materialize

#: The base kinds in their order, their patterns (failing matches
#: of ``assign`` are dropped by the length of what is assigned).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGNED = 6
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Tokens that the models judge: long, with a digit.
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{16,}"
#: Words of the ordinary sample: shorter than what the models judge.
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{4,15}(?![A-Za-z0-9+/_=-])"
KINDS = ("assign", "access", "hex", "markov")
#: Documents whose words and ids make up the labelled samples, at most.
SAMPLE_DOCS = 1000
MARGIN = 1.0
#: Weight of a character's overall share in its share after another one.
PRIOR = 5.0
REDACTED = "[SECRET]"


def train_ratio(docs: DataFrame) -> list[float]:
    """Log-likelihood ratios of all character pairs, random over ordinary.

    Fitted on a bounded labelled sample: the ``SAMPLE_DOCS`` documents with the
    least hash of id and text. The result has a number for each pair of the
    alphabet, whatever the corpus is like; shares after a character are drawn
    towards the overall ones.
    """
    sample = docs.select(F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    sample = sample.orderBy(F.xxhash64("id", "text")).limit(SAMPLE_DOCS)
    digest = F.sha2(F.coalesce("id", F.lit("")), 256)
    random = sample.select(F.explode(F.array(digest, F.base64(F.unhex(digest)))).alias("s")).withColumn("random", F.lit(True))
    words = sample.select(F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("s")).withColumn("random", F.lit(False))
    pairs = (random.unionByName(words)
             .select("random", F.explode(F.expr("transform(sequence(1, length(s) - 1), i -> substr(s, i, 2))")).alias("pair"))
             .groupBy("random", "pair").agg(F.count("*").alias("n")).collect())
    n = len(ALPHABET)
    place = {c: i for i, c in enumerate(ALPHABET)}
    counts = {r: [[0.0] * n for _ in range(n)] for r in (True, False)}
    for r in pairs:
        counts[r["random"]][place[r["pair"][0]]][place[r["pair"][1]]] += r["n"]
    share = {}
    for kind, table in counts.items():
        after = [sum(column) + 0.5 for column in zip(*table, strict=True)]
        share[kind] = [[math.log((x + PRIOR * a / sum(after)) / (sum(row) + PRIOR)) for x, a in zip(row, after, strict=True)] for row in table]
    return [round(a - b, 4) for x, y in zip(share[True], share[False], strict=True) for a, b in zip(x, y, strict=True)]


def randomness(token: str, ratio: list[float]) -> str:
    """SQL of the mean log-likelihood ratio of the characters of ``token``."""
    n, table = len(ALPHABET), f"cast(split('{','.join(map(str, ratio))}', ',') AS array<float>)"
    return (f"(aggregate(sequence(1, length({token}) - 1), 0D, (t, j) -> t + {table}["
            f"{n} * (instr('{ALPHABET}', substr({token}, j, 1)) - 1) + instr('{ALPHABET}', substr({token}, j + 1, 1)) - 1])"
            f" / (length({token}) - 1))")


def _matches(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Array of (kind, i, gap, length, value): matches with the length of the
    text before each of them, in order; a last one stands for the rest."""
    empty = F.array().cast("array<struct<kind:string,i:int,gap:int,length:int,value:string>>")
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v"))
    made = F.transform(zipped, lambda s, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.char_length(s["g"]).alias("gap"), F.char_length(s["m"]).alias("length"), s["v"].alias("value")))
    return F.when(text.rlike(pattern), made).otherwise(empty)


PATTERNS = (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), ("markov", TOKEN, 0))


def secret_spans(docs: DataFrame, ratio: list[float]) -> DataFrame:
    """row, doc_id, kind, start, end (code points), base: every span; and a
    row without a kind for each document row that has none."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    found = rows.select("doc_id", "row", F.explode_outer(F.concat(*(_matches(F.col("text"), *p) for p in PATTERNS))).alias("s"))
    found = materialize(found.select("doc_id", "row", "s.*").where("kind IS NULL OR length IS NOT NULL"), "secret-matches")
    before = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("length")).over(before)
    placed = found.where("kind IS NOT NULL").withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
    good = (F.when(F.col("kind") == "assign", F.char_length("value") >= ASSIGNED)
            .when(F.col("kind") == "markov", F.expr(randomness("value", ratio)) > MARGIN).otherwise(True))
    spans = placed.where(good).select("row", "kind", "start", "end")
    # a token adds a span where the base has none: the furthest base end before a start tells
    order = Window.partitionBy("row").orderBy("start", (F.col("kind") == "markov").cast("int"))
    base_end = F.when(F.col("kind") != "markov", F.col("end"))
    base_start = F.when(F.col("kind") != "markov", F.col("start"))
    spans = (spans.withColumn("reach", F.max(base_end).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .withColumn("coming", F.min(base_start).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
             .where("kind != 'markov' OR (coalesce(reach, 0) <= start AND coalesce(coming, end) >= end)")
             .select("row", "kind", "start", "end"))
    ids = found.select("row", "doc_id").distinct()
    return ids.join(spans, "row", "left")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans."""
    spans = secret_spans(docs, train_ratio(docs))
    rank = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END")
    item = F.when(F.col("kind").isNotNull(), F.struct(F.col("start"), rank.alias("rank"), F.concat_ws(":", "kind", "start", "end").alias("span")))
    return (spans.withColumn("item", item)
            .groupBy("row", "doc_id").agg(
                *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS),
                F.array_sort(F.collect_list("item")).alias("found"))
            .select("doc_id", "n_assign", "n_access", "n_hex",
                    F.sha2(F.expr(f"array_join(transform(filter(found, f -> f.rank < {len(KINDS) - 1}), f -> f.span), ',')"), 256).alias("base_sha256"),
                    F.expr("array_join(transform(found, f -> f.span), ',')").alias("spans"), "n_markov"))


def redact(docs: DataFrame, ratio: list[float], text: str = "text") -> DataFrame:
    """``docs`` with secrets in ``text`` replaced; of an assignment only the
    value goes. Each kind is replaced in what the kinds before it left. Other
    columns pass through, whatever their names."""
    out, parts = docs, "parts"
    while parts in docs.columns:
        parts = f"_{parts}"
    for kind, pattern, group in PATTERNS:
        col = F.col(text)
        zipped = F.arrays_zip(F.split(col, pattern, -1).alias("g"), F.regexp_extract_all(col, F.lit(pattern), F.lit(0)).alias("m"),
                              F.regexp_extract_all(col, F.lit(pattern), F.lit(group)).alias("v"))
        secret = {"assign": f"length(s.v) >= {ASSIGNED}", "markov": f"{randomness('s.v', ratio)} > {MARGIN}"}.get(kind, "true")
        rebuilt = F.expr(f"array_join(transform({parts}, s -> concat(s.g, CASE WHEN s.m IS NULL THEN '' "
                         f"WHEN {secret} THEN concat(left(s.m, length(s.m) - length(s.v)), '{REDACTED}') ELSE s.m END)), '')")
        out = (out.withColumn(parts, F.when(col.rlike(pattern), zipped))
               .withColumn(text, F.when(F.col(parts).isNull(), col).otherwise(rebuilt)).drop(parts))
    return out

