"""The pipeline's stages on rows that a doc_id doesn't tell apart, and the bounds of the encoder."""

from collections import Counter

import pyarrow as pa
import pytest

pytest.importorskip("starmart.llm")
import corpus_pipeline  # noqa: E402
from starmart.llm import secret_scan, sentence_pieces  # noqa: E402
from starmart.llm.queries import PIECES, tokenizer_path  # noqa: E402

SF = "/root/testdata/sf0.001"
#: Documents and more columns, some with names that operators use.
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row long, parts string, ids string"
STAGES = dict(corpus_pipeline.STAGES)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, "p", "i") for i, t in rows], COLUMNS)


def found(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_benchmark_stage_judges_each_row(spark):
    item = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len((r["text"] or "").split()) > 12)
    clean = [(None, "nothing of it here"), (9, "nor here"), (None, None), (None, ""), (9, "nor here")]
    docs = documents(spark, [*clean, (None, f"so {item} it is"), (9, item)])
    out = STAGES["benchmark decontamination"](spark, docs, SF)
    assert out.columns == docs.columns and found(out) == Counter(clean)


def test_near_duplicate_stage_keeps_one_row_a_group(spark):
    text = " ".join(f"w{i}" for i in range(40))
    near = text + " w40"
    other = " ".join(f"v{i}" for i in range(40))
    rows = [(None, text), (None, text), (8, near), (5, text), (5, text), (5, other), (None, other), (None, None), (None, None), (3, ""), (3, "")]
    out = STAGES["n-gram jaccard join"](spark, documents(spark, rows), SF)
    assert found(out) == Counter([(5, text), (5, other), (None, None), (None, None), (3, ""), (3, "")])
    alone = [(None, text), (None, text), (None, other)]  # no id repeats here
    assert found(STAGES["n-gram jaccard join"](spark, documents(spark, alone), SF)) == Counter([(None, text), (None, other)])


def test_quality_stage_judges_rows_without_an_id_by_their_text(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    known = {r["doc_id"] for r in labels.collect()}
    before = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in docs.collect()]
    free = [(None, *r[1:]) for r in before if r[0] not in known]
    doubled = spark.createDataFrame([*before, *free], docs.schema)
    out = [(r["doc_id"], r["text"]) for r in STAGES["quality classifier"](spark, doubled, SF).collect()]
    assert Counter(t for i, t in out if i is None) == Counter(t for i, t in out if i is not None and i not in known)


@pytest.mark.parametrize("name", STAGES)
def test_stages_on_an_empty_table(spark, name):
    assert STAGES[name](spark, documents(spark, [(1, "x")]).limit(0), SF).collect() == []


def test_redact_and_encode_keep_other_columns(spark):
    docs = documents(spark, [(1, "password = hunter22"), (None, None)])
    kept = secret_scan.redact(docs, secret_scan.train_ratio(docs))
    assert kept.columns == docs.columns and {r["parts"] for r in kept.collect()} == {"p"}
    coded = sentence_pieces.encode_documents(docs, tokenizer_path(PIECES)).collect()
    assert {(r["row"], r["parts"]) for r in coded} == {(7, "p")} and all(isinstance(r["ids"], list) for r in coded)


def test_blocks_give_the_ids_of_whole_texts(monkeypatch):
    import sentencepiece

    path = tokenizer_path(PIECES)
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), sentence_pieces.PieceModel(path, memo_words=20)
    texts = ["", " ", "   ", "one", "  two  words ", "日本語" * 40, "▁ a ▁▁b", "a" * 100 + " " + "b" * 33, "the quick brown fox " * 30, "x  \n\n y\t" * 20, "é" * 31 + " " * 50]
    for block in (1, 7, 64):
        monkeypatch.setattr(sentence_pieces, "BLOCK", block)
        monkeypatch.setattr(sentence_pieces, "MERGED", block)
        for _ in range(2):
            for text, ids in zip(texts, own.encode(texts), strict=True):
                assert pa.py_buffer(ids).size == 4 * len(library.encode(text, add_bos=True, add_eos=True))
                assert memoryview(ids).cast("I").tolist() == library.encode(text, add_bos=True, add_eos=True), (block, text)
        assert all(len(w) <= sentence_pieces.MEMO_CHARS for w in own.memo)
        batch = pa.RecordBatch.from_arrays([pa.array([*texts, None])], names=["text"])
        assert [t for rows in sentence_pieces.row_slices(batch, "text") for t in rows.column(0).to_pylist()] == [*texts, None]
