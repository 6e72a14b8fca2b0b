"""License scan by diagonal voting.

Native DataFrame code. Every rolling word ``GRAM``-gram of every document is
hashed and joined with the places where license templates have it. A hit votes
for its offset diagonal (place in the document minus place in the template);
neighbouring diagonals, which a few inserted or missing words tell apart, are
merged; and a merged span is verified by the share of the template's distinct
places that it covers. A phrase of the base list counts at each diagonal that
has all its grams.

Defined results: null and empty texts and texts without words have no words,
no labels and score 0.0; repeated rows are scanned and returned each; a null
doc_id is kept. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import ascii_lower, cased_words, materialize

GRAM = 2
#: Diagonals that differ by this much or less belong to one span.
NEIGHBOUR = 3
#: Share of a template's grams that a span has to cover.
COVERED = 0.6

#: The base phrases, all of whose places count, and their labels.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Sentences by which license texts and notices are known.
TEMPLATES = {
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "apache-notice": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache": "licensed under the apache license version 2 0",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl": "licensed under the gnu general public license version 3",
    "lgpl": "gnu lesser general public license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl": "this source code form is subject to the terms of the mozilla public license",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-by": "creative commons attribution 4 0 international license",
    "unlicense": "this is free and unencumbered software released into the public domain",
}


def template_places(spark) -> DataFrame:
    """A row for each gram of each template: a few hundred, fixed rows."""
    rows = []
    for is_base, known in ((True, BASE.items()), (False, ((t, n) for n, t in TEMPLATES.items()))):
        for text, label in known:
            words = text.split()
            rows += [f"('{'base' if is_base else 'text'}:{text}', {is_base}, '{label}', {len(words) - GRAM + 1}, {i}, '{words[i]}', '{words[i + 1]}')"
                     for i in range(len(words) - GRAM + 1)]
    table = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(template, is_base, label, grams, at, one, two)")
    return table.withColumn("gram", F.xxhash64("one", "two"))


def gram_hits(docs: DataFrame) -> DataFrame:
    """Where documents and templates share a gram; and a row at place 0, or
    without a place, for each document row's number of words."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), cased_words(F.col("text")).alias("words"))
    grams = rows.select("doc_id", "row", F.size("words").alias("n_words"), "words", F.posexplode_outer("words").alias("place", "first"))
    grams = grams.select("doc_id", "row", "n_words", "place", "first", F.expr("get(words, place + 1)").alias("second"))
    templates = F.broadcast(template_places(docs.sparkSession))
    same = ((F.xxhash64(F.lower("first"), F.lower("second")) == F.col("gram"))
            & (ascii_lower(F.col("first")) == F.col("one")) & (ascii_lower(F.col("second")) == F.col("two")))
    return (grams.join(templates, same, "left").where("gram IS NOT NULL OR place IS NULL OR place = 0")
            .select("doc_id", "row", "n_words", "place", "template", "is_base", "label", "grams", "at"))


def license_spans(hits: DataFrame) -> DataFrame:
    """row, template, label, is_base, start, end (words), covered (0 to 1)."""
    votes = (hits.where("template IS NOT NULL").withColumn("diagonal", F.col("place") - F.col("at"))
             .groupBy("row", "template", "is_base", "label", "grams", "diagonal")
             .agg(F.collect_set("at").alias("at"), F.min("place").alias("start"), F.max("place").alias("end")))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    # phrases count diagonal by diagonal, texts over neighbouring ones
    far = F.col("is_base") | (F.col("diagonal") - F.coalesce(F.lag("diagonal").over(order), F.col("diagonal")) > NEIGHBOUR)
    spans = (votes.withColumn("new", far.cast("int")).withColumn("span", F.sum("new").over(order))
             .groupBy("row", "template", "is_base", "label", "grams", "span")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("met"), F.min("start").alias("start"), F.max("end").alias("end")))
    return spans.select("row", "template", "is_base", "label", "start", (F.col("end") + GRAM).alias("end"), (F.col("met") / F.col("grams")).alias("covered"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    hits = materialize(gram_hits(docs), "license-hits")
    whole = F.col("is_base") & (F.col("covered") == 1)
    known = whole | (~F.col("is_base") & (F.col("covered") >= COVERED))

    def joined(which):
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    found = license_spans(hits).groupBy("row").agg(
        F.count(F.when(whole, 1)).alias("n_base"),
        F.min(F.when(whole, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(whole, F.col("start"))).cast("long").alias("last_word"),
        joined(whole).alias("base_labels"), joined(known).alias("labels"),
        F.max("covered").alias("score"))
    rows = hits.where("place IS NULL OR place = 0").select("row", "doc_id", F.col("n_words").cast("long").alias("n_words")).distinct()
    return rows.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
