"""Benchmark decontamination on a distributed positional inverted index.

Native DataFrame code. Document words are exploded with their places and only
postings of search terms are stored: for each window of a test item, the term
that is rarest in the documents. A posting carries the words around it, as many
as a window can reach. Each window then starts from the postings of its rarest
term, is laid against them at the term's offset, and is kept where all its
words stand in place (exact phrases). :func:`proximity_matches` intersects the
postings of an item's rarest terms within a distance instead.

The test items are the small side: their windows are broadcast if they are few
(``BROADCAST_ROWS``, checked), and joined by shuffle beyond that.

Defined results: null and empty texts and texts without words have no words
and no hits; items without words are never found; repeated items count once by
item_id; repeated document rows are counted and
returned each; a null doc_id is a document like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import ascii_lower, cased_words, materialize

#: Windows of test items that are broadcast at most; a window takes some 300 bytes.
BROADCAST_ROWS = 200_000


# Terms are compared in full lower case, which equal words share; the words of
# a match are then compared with only A-Z lower-cased.


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """window (array of words) and the sorted ids of the items it is from."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"),
                         F.transform(cased_words(F.col("text")), ascii_lower).alias("words")).where("size(words) > 0")
    cut = F.expr(f"transform(sequence(1, greatest(1, size(words) - {size - 1})), i -> slice(words, i, {size}))")
    return (words.select("item_id", F.explode(cut).alias("window"))
            .groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("items")))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def document_words(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.monotonically_increasing_id().alias("row"), cased_words(F.col("text")).alias("words"))


def term_counts(words: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of the terms stands in the documents. An inner explode would
    have Spark infer a filter on the words and extract them once more for it."""
    return (words.select(F.explode_outer("words").alias("word")).select(F.lower("word").alias("term"))
            .join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n")))


def search_terms(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window with its rarest term (the first of equally rare ones) and
    the term's offset in it."""
    places = windows.select("window", F.posexplode("window").alias("offset", "word")).withColumn("term", F.lower("word")).join(counts, "term", "left")
    rarest = places.groupBy("window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term")).alias("r"))
    return rarest.select("window", F.col("r.term").alias("term"), F.col("r.offset").alias("offset"), F.col("r.n").alias("n"))


def postings(words: DataFrame, terms: DataFrame, size: int) -> DataFrame:
    """The index: term, doc_id, row, place and the words around; and a posting
    at place 0, or without a place, for each row's number of words. Rows are
    numbered here and only here: everything else reads the stored index."""
    found = words.select("doc_id", "row", F.size("words").alias("n_words"), "words", F.posexplode_outer("words").alias("place", "word"))
    around = F.expr(f"slice(words, greatest(place - {size - 2}, 1), least(place, {size - 1}) + {size})")
    hits = found.join(terms, F.lower("word") == F.col("term"), "left").where("term IS NOT NULL OR place IS NULL OR place = 0")
    return hits.select("doc_id", "row", "n_words", "place", "term", F.when(F.col("term").isNotNull(), around).alias("around"))


def exact_matches(index: DataFrame, search: DataFrame, size: int) -> DataFrame:
    """row, doc_id, start and window of each place where a window stands."""
    begin = F.expr(f"least(place, {size - 1}) - offset")  # where the window starts in the words around, from 0
    laid = F.expr("slice(around, first + 1, size(window))")
    return (index.where("term IS NOT NULL").join(search, "term")
            .withColumn("first", begin).where("first >= 0 AND offset <= place")
            .where(F.transform(laid, ascii_lower) == F.col("window"))
            .select("row", "doc_id", (F.col("place") - F.col("offset")).alias("start"), "window"))


def proximity_matches(index: DataFrame, items: DataFrame, counts: DataFrame, distance: int, terms: int = 3) -> DataFrame:
    """doc_id, item_id: documents where the item's rarest ``terms`` terms that
    the index holds stand within ``distance`` words of the rarest of them."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), F.explode(F.array_distinct(F.transform(cased_words(F.col("text")), F.lower))).alias("term"))
    ranked = (words.join(counts, "term").groupBy("item_id")
              .agg(F.slice(F.array_sort(F.collect_list(F.struct("n", "term"))), 1, terms).alias("rare")).where(F.size("rare") == terms))
    lead = ranked.select("item_id", F.col("rare")[0]["term"].alias("term"))
    rest = ranked.select("item_id", F.explode(F.expr(f"slice(rare, 2, {terms - 1})")["term"]).alias("other"))
    held = index.where("term IS NOT NULL").select("doc_id", "place", "term")
    near = (held.join(lead, "term").join(rest, "item_id")
            .join(held.select(F.col("doc_id").alias("d"), F.col("place").alias("p"), F.col("term").alias("other")), "other")
            .where((F.col("doc_id") == F.col("d")) & (F.abs(F.col("place") - F.col("p")) <= distance)))
    return (near.groupBy("doc_id", "item_id", "place").agg(F.countDistinct("other").alias("found"))
            .where(F.col("found") == terms - 1).select("doc_id", "item_id").distinct())


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted array), contaminated."""
    windows = materialize(item_windows(items, size), "windows")
    n_windows = windows.count()
    words = document_words(docs)
    terms = windows.select(F.explode("window").alias("word")).select(F.lower("word").alias("term")).distinct()
    counts = materialize(term_counts(words, _small(terms, n_windows)), "term-counts")
    search = materialize(search_terms(windows, counts).where("n > 0"), "search")
    index = materialize(postings(words, _small(search.select("term").distinct(), n_windows), size), "postings")
    matches = materialize(exact_matches(index, _small(search, n_windows), size), "matches")
    places = matches.select("row", F.explode(F.expr("sequence(start, start + size(window) - 1)")).alias("place"))
    hit = places.distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    found = (matches.select("row", "window").distinct().join(_small(windows, n_windows), "window")
             .select("row", F.explode("items").alias("item")).distinct()
             .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items")))
    rows = index.where("place IS NULL OR place = 0").select("row", "doc_id", F.col("n_words").cast("long").alias("n_words")).distinct()
    return (rows.join(hit.join(found, "row"), "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.greatest(F.coalesce(F.size("items"), F.lit(0)), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.col("n_hit").isNotNull().alias("contaminated")))
