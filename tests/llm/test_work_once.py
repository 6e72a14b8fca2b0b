"""Plans and task outputs that do a piece of work once."""

from starmart.llm import decontaminate, phrase_fingerprints


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _documents(spark):
    rows = [(i, f"text {i} of a few words more") for i in range(6)] + [(None, "no id"), (2, "text 2 of a few words more"), (7, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_fingerprints_deal_texts_and_starts_once(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(phrase_fingerprints.edited_fingerprints(_documents(spark)))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert len([line for line in dealt if "to_key" in line]) == 1, plan
    assert len([line for line in dealt if "text_key" in line]) == 2, plan  # the order, and the packed texts once
    assert plan.count("ReusedExchange") == 1, plan


def test_terms_are_extracted_once(spark):
    words = decontaminate.document_words(_documents(spark))
    terms = spark.createDataFrame([("words",), ("no",)], "term string")
    counts = decontaminate.term_counts(words, terms)
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert {r["term"]: r["n"] for r in counts.collect()} == {"words": 7, "no": 1}
