"""Cross-tokenizer alignment against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest

pytest.importorskip("starmart.llm")
import public_tokenizers  # noqa: E402

from starmart.llm import token_alignment as ta  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = "doc_id long, text string, lang string, chunk long, pair long, link long, held string"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(texts, libraries):
    """Per text: A ids, B ids, groups, links (by pairwise range tests)."""
    tok, sp = libraries
    own = ta.tokenizers_of(A, B)
    out = []
    for t in texts:
        a, b = ([], []) if not t else (tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t))
        data = (" " + (t or "")).encode()
        if any(b"".join(side.bytes[i] for i in ids) != data for side, ids in ((own.a, a), (own.b, b))):
            a, b = [], []
        ra, rb = ([], [])
        for side, ids, spans in ((own.a, a, ra), (own.b, b, rb)):
            at = 0
            for i in ids:
                spans.append((at, at + len(side.bytes[i])))
                at = spans[-1][1]
        links = [(i, j) for i, x in enumerate(ra) for j, y in enumerate(rb) if max(x[0], y[0]) < min(x[1], y[1])]
        groups, ga, gb = [], [], []
        for cut in sorted({e for _, e in ra} & {e for _, e in rb}):
            ga, gb = ([ids[i] for i, s in enumerate(spans) if (groups[-1][2] if groups else 0) < s[1] <= cut] for ids, spans in ((a, ra), (b, rb)))
            groups.append((ga, gb, cut))
        out.append((a, b, groups, links))
    return out


def expected(rows, libraries):
    made = brute([t for _, t in rows], libraries)
    held = collections.Counter()
    for a, b, _, links in made:
        held.update({(a[i], b[j]) for i, j in links})
    most = collections.defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for (doc, _), (a, b, groups, links) in zip(rows, made, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y, _ in groups)
        counts = [held[a[i], b[j]] for i, j in links]
        out.append((doc, len(a), len(b), len(groups), len(links), sum(n == most[a[i]] for n, (i, _) in zip(counts, links, strict=True)), sum(counts),
                    hashlib.sha256(text.encode()).hexdigest() if a else "", sum(len(x) * len(y) for x, y, _ in groups)))
    return out


def fixture():
    rng = random.Random(3)
    rows = [(None, None), (1, None), (2, ""), (3, " "), (4, "\n\t  x"), (5, "a▁b"), (6, "<|endoftext|> </s> <s> <unk> <0x41> [INST]"), (7, "日本語 😀é\x00"), (7, "twice"),
            (7, "twice"), (None, "no id"), (8, "the cat sat on the mat. " * 200), (9, "ab" * 700)]
    words = ["the", "naïve", "Straße", "x1", "über", "don't", "1234", "  ", "=>", "\n", "été", "antidisestablishment", "😀"]
    return rows + [(100 + i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(60)]


def test_digests_equal_brute_force(spark, libraries, monkeypatch):
    rows = fixture()
    frame = spark.createDataFrame([(*r, "l", 1, 2, 3, "s") for r in rows], COLUMNS).repartition(3)
    got = [tuple(r) for r in ta.alignment_digests(frame, A, B).collect()]
    order = lambda r: tuple(map(str, r))
    assert sorted(got, key=order) == sorted(expected(rows, libraries), key=order)


def test_empty_table(spark):
    assert ta.alignment_digests(spark.createDataFrame([], COLUMNS), A, B).collect() == []


def test_alignments_of_documents(spark, libraries):
    rows = fixture()
    frame = spark.createDataFrame([(*r, "l", 1, 2, 3, "s") for r in rows], COLUMNS).coalesce(1)
    got = ta.align_documents(frame, A, B).collect()
    assert [(r["doc_id"], r["text"], r["held"]) for r in got] == [(*r, "s") for r in rows]
    for r, (a, b, groups, links) in zip(got, brute([t for _, t in rows], libraries), strict=True):
        al = r["alignment"]
        assert (al["a"], al["b"]) == (a, b)
        assert list(zip(al["link_a"], al["link_b"], strict=True)) == links
        assert sum(al["link_bytes"]) == (len((" " + r["text"]).encode()) if a else 0)
        assert [[x for x, g in zip(al["a"], al["group_a"], strict=True) if g == i] for i in range(len(groups))] == [g[0] for g in groups]
        assert [[x for x, g in zip(al["b"], al["group_b"], strict=True) if g == i] for i in range(len(groups))] == [g[1] for g in groups]


def test_row_products_equal_dense_ones(monkeypatch):
    monkeypatch.setattr(ta, "BLOCK", 7)
    rng = np.random.default_rng(0)
    for _ in range(30):
        dense = [rng.integers(0, 3, s) * (rng.random(s) < 0.4) for s in ((6, 9), (9, 5))]
        sparse = []
        for m in dense:
            ptr = np.concatenate(([0], np.cumsum((m != 0).sum(1))))
            sparse.append(ta.Csr(ptr, np.nonzero(m)[1], m[m != 0], m.shape[1]))
        row, column, value = sparse[0].product(sparse[1])
        out = np.zeros((6, 5), np.int64)
        out[row, column] = value
        assert (out == dense[0] @ dense[1]).all()
        back = sparse[0].transpose().transpose()
        assert back.indptr.tolist() == sparse[0].indptr.tolist() and back.indices.tolist() == sparse[0].indices.tolist()


def test_shared_group_links(libraries):
    texts = [t for _, t in fixture()]
    al = ta.tokenizers_of(A, B).align(texts)
    pairs = {(i, j) for rows, columns in al.shared_group_links() for i, j in zip(rows.tolist(), columns.tolist(), strict=True)}
    assert len(pairs) == al.n_shared.sum()
    assert all(al.group_a[i] == al.group_b[j] for i, j in pairs)


def test_ranks_give_the_library_ids_for_every_code_point(libraries):
    """Each code point among letters, digits, spaces and marks."""
    own = ta.ByteTokens(A)
    assert own.ranks is not None
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f" a{c}b {c}{c}1{c} {c}!{c}" for c in points]
    for at in range(0, len(texts), 100_000):
        part = texts[at:at + 100_000]
        for text, ids, lib in zip(part, own.encode(part), libraries[0].encode_batch(part, add_special_tokens=False), strict=True):
            assert ids.tolist() == lib.ids, text
