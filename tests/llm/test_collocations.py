"""Collocations against brute force; tries, spills and long texts."""

import bisect
import collections
import random
import re

import numpy as np
import pytest

pytest.importorskip("starmart.llm")

from starmart.llm import collocations as co  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, phrase string, n long, words int, rank int"


def counts(rows, max_words):
    freq = collections.Counter()
    for text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    freq[(lang or "und", tuple(w[i:i + k]))] += 1
    return freq


def brute(rows, max_words=3, least=10, top=2000):
    freq = counts(rows, max_words)
    cand = {key: a for key, a in freq.items() if len(key[1]) > 1 and a >= least}
    sizes = collections.Counter()
    for (lang, w), a in freq.items():
        sizes[lang] += a * (len(w) == 1)
    found = collections.defaultdict(list)
    for (lang, w), a in cand.items():
        if any(lg == lang and len(v) > len(w) and 100 * b >= 50 * a and any(v[i:i + len(w)] == w for i in range(len(v))) for (lg, v), b in cand.items()):
            continue
        cuts = [(10**6 * a * a // (freq[lang, w[:k]] * freq[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(w).encode(), freq[lang, w[:k]], freq[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, sizes[lang], -s) for lang, items in found.items() for i, (s, a, p, l, r) in enumerate(sorted(items)[:top]))


def rows_of(frame, **options):
    return sorted(tuple(r) for r in co.collocations(frame, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = [(None, "en"), ("", "en"), (None, None), (" \t ", "xx"), ("New York\tCity. " * 40, "en"), ("new york! " * 12, None), ("É É É É é " * 30, "fr"), ("a\x00b c\x0bd " * 15, "xx"),
           ("solo", "yy"), ("one two three four five " * 11, "zz"), ("one two three four five " * 11, "zz")]
    for lang in ("en", "de", None):
        words = [f"w{i}" for i in range(12)] + ["the", "Of", "x-1", "été"]
        out += [(" ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(rng.randint(0, 120))), lang) for _ in range(60)]
    return out


def frame_of(spark, texts):
    return spark.createDataFrame([(i % 7, t, lang, "p", 1, 1, 1) for i, (t, lang) in enumerate(texts)], COLUMNS).repartition(3)


@pytest.mark.parametrize("options", [{}, {"max_words": 4, "least": 5, "top": 30}, {"max_words": 2, "held": 50}])
def test_equals_brute_force(spark, texts, options):
    expected = brute(texts, **{k: v for k, v in options.items() if k != "held"})
    assert expected and rows_of(frame_of(spark, texts), **options) == expected


def test_hot_parts_are_salted_alike(spark, texts, monkeypatch):
    monkeypatch.setattr(co, "HOT_SHARE", 20)
    assert rows_of(frame_of(spark, texts), least=5) == brute(texts, least=5)


def test_empty_table(spark):
    assert co.collocations(spark.createDataFrame([], COLUMNS)).collect() == []


@pytest.mark.parametrize("held, container, block", [(1 << 20, 1 << 14, 500_000), (200, 8, 500_000), (1000, 16, 7), (1 << 20, 1, 3)])
def test_runs_add_up_whatever_spills(texts, monkeypatch, held, container, block):
    monkeypatch.setattr(co, "BLOCK_TOKENS", block)
    counter = co.PhraseCounter(3, held, container)
    got, runs = collections.Counter(), []
    for text, lang in texts:
        runs += list(counter.add(lang or "und", (text or "").encode()))
    runs += list(counter.finish())
    splitters = sorted({(r.lang, tuple(r.phrase(i))) for r in runs for i in range(0, len(r.keys), 9)} | {("en", (b"w", b"zz")), ("aa", (b"x",)), ("zzz", (b"y",))})
    for run in runs:
        phrases = [tuple(run.phrase(i)) for i in range(len(run.keys))]
        assert phrases == sorted(phrases) and len(set(phrases)) == len(phrases)
        found = [(part, r["phrase"], r["words"], r["n"]) for part, table in run.slices([(lang, list(p)) for lang, p in splitters]) for r in table.to_pylist()]
        assert [(b" ".join(p), len(p)) for p in phrases] == [f[1:3] for f in found]
        assert [bisect.bisect_right(splitters, (run.lang, p)) for p in phrases] == [f[0] for f in found]
        for p, f in zip(phrases, found, strict=True):
            got[run.lang, tuple(w.decode() for w in p)] += f[3]
    assert got == counts(texts, 3)


def test_containers_hold_what_a_dict_holds():
    rng = np.random.default_rng(4)
    table, held = co.Container(4), collections.Counter()
    for _ in range(50):
        keys, n = np.unique(rng.integers(0, 3000, 200), return_counts=True)
        table.add(keys, n)
        held.update(dict(zip(keys.tolist(), n.tolist(), strict=True)))
    keys, n = table.items()
    assert dict(zip(keys.tolist(), n.tolist(), strict=True)) == held and table.size == len(held)


def test_many_partitions(spark, texts, monkeypatch):
    monkeypatch.setattr(co, "PART_BYTES", 500)
    monkeypatch.setattr(co, "SAMPLE_BYTES", 10_000)
    assert rows_of(frame_of(spark, texts)) == brute(texts)


def test_products_beyond_64_bits(spark):
    rows = [(a, l, r) for a, l, r in ((10**15, 10**15, 10**15), (10**15 - 1, 10**15 + 7, 10**15 + 9), (123456789012345, 223456789012345, 323456789012345), (3, 7, 11))]
    frame = spark.createDataFrame(rows, "a long, l long, r long").selectExpr(
        *[f"cast({c} as decimal(38,0)) {c}" for c in "alr"]).selectExpr("(cast(1000000 as decimal(38,0)) * a * a) div (l * r) s")
    assert [r["s"] for r in frame.collect()] == [10**6 * a * a // (l * r) for a, l, r in rows]
