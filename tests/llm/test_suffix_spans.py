"""Removal of repeated byte spans against brute force."""

import hashlib
import random

import numpy as np
import pytest

pytest.importorskip("starmart.llm")

from starmart.llm import suffix_spans as ss  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, chunk long, data string, size int, kept string"


def brute(rows, window=50):
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - window + 1) if doc is not None else ():
            first[data[i:i + window]] = min(doc, first.get(data[i:i + window], doc))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - window + 1) if doc is not None else ():
            if first[data[i:i + window]] < doc:
                gone[i:i + window] = True
        rest = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = sum(1 for i in range(len(data)) if gone[i] and not (i and gone[i - 1]))
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(), rest))
    return out


def fixture(seed=1, n=120):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "été", "x", "\n", "the quick brown fox", "0123456789", "\x00\x00", "日本語"]
    passage = " ".join(rng.choices(words, k=60))
    other = " ".join(rng.choices(words, k=40))
    rows = [(None, passage), (None, None), (1, None), (2, ""), (3, "short"), (4, "a" * 400), (5, "a" * 49), (6, "b" + "a" * 60), (7, "\x00" * 120), (8, "\x00" * 70), (-5, passage[:200]), (9, passage), (9, passage),
            (9, other), (10, other), (10, "tail " + other[30:] + passage[-90:]), (11, "ab" * 100), (12, "ba" * 100), (13, "é" * 200), (14, "x" + "é" * 60)]
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.randint(0, 40)))
        for _ in range(rng.randint(0, 3)):
            source = rng.choice(rows)[1] or ""
            a = rng.randint(0, len(source))
            text += source[a:a + rng.randint(0, 150)]
        rows.append((rng.choice([100 + i, 100 + i // 2, i]), text))
    rng.shuffle(rows)
    return rows


def result(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "l", 1, "d", 2, "k") for r in rows], COLUMNS).repartition(3)
    return sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in ss.remove_repeated_bytes(frame, **options).collect()), key=str)


def test_equals_brute_force(spark):
    rows = fixture()
    assert result(spark, rows) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("pack, block, shard, bucket", [(300, 64, 500, 5), (2000, 100, 4000, 2), (1 << 20, 1 << 18, 1 << 20, 40)])
def test_small_packs_shards_and_buckets(spark, monkeypatch, pack, block, shard, bucket):
    """Groups that go on over many buckets meet across their boundaries."""
    for name, value in (("PACK_BYTES", pack), ("BLOCK", block), ("SHARD_BYTES", shard), ("BUCKET_SUFFIXES", bucket), ("SAMPLES", bucket)):
        monkeypatch.setattr(ss, name, value)
    rows = fixture(seed=bucket, n=60)
    assert result(spark, rows) == sorted(brute(rows), key=str)


def test_other_sizes(spark):
    rows = fixture(seed=9, n=40)
    assert result(spark, rows, window=24, anchor=8) == sorted(brute(rows, 24), key=str)
    assert result(spark, rows, window=16, anchor=16, kept=False) == sorted((r[:5] for r in brute(rows, 16)), key=str)


def test_empty_table(spark):
    assert ss.remove_repeated_bytes(spark.createDataFrame([], COLUMNS)).collect() == []


def test_multikey_order():
    rng = np.random.default_rng(1)
    for n, top in ((1, 2), (50, 2), (300, 3), (1000, 1 << 60)):
        words = rng.integers(0, top, (n, 5)).astype(np.uint64)
        got = words[ss.multikey_order(words)].tolist()
        assert got == sorted(words.tolist())
    assert ss.multikey_order(np.empty((0, 3), np.uint64)).tolist() == []
