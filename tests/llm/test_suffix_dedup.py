import hashlib
import random
from collections import Counter

import numpy as np
from quern.llm.suffix_dedup import multikey_order, op1_suffix_dedup, without_repeats


def brute(texts, size):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + size] for b in data for i in range(len(b) - size + 1))
    out = []
    for b in data:
        gone = [False] * len(b)
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = [True] * size
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def made(seed, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randint(1, 9)))
    body = lambda k: " ".join(word() for _ in range(k))
    shared = [body(r.randint(4, 30)) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = [r.choice(shared) if r.random() < 0.5 else body(r.randint(1, 30)) for _ in range(r.randint(1, 6))]
        texts.append(" ".join(parts))
    return [*texts, None, "", "ab" * 150, "ab" * 150, texts[0], "z" * 39, "z" * 39, "y" * 40, "x" * 41]


def check(spark, texts, size):
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, kind string, s1 int").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in without_repeats(df, min_bytes=size).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, size)


def test_against_brute_force(spark):
    for seed, size in ((1, 40), (2, 40), (3, 17)):
        check(spark, made(seed), size)


def test_ranges_of_long_texts_by_blocks(spark, monkeypatch):
    from quern.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "STARTS", 64)
    r = random.Random(6)
    long = "".join(r.choice("abcd ") for _ in range(3000))
    check(spark, [long, long, long[:1500] + "X" + long[1500:], "q" + long[700:800], *made(4, 20)], 40)


def test_buckets_grow_with_the_input(spark, monkeypatch):
    from quern.llm import suffix_dedup

    seen, ranged = [], suffix_dedup._ranged
    monkeypatch.setattr(suffix_dedup, "_ranged", lambda s, least: seen.append((least, (got := ranged(s, least)).rdd.getNumPartitions())) or got)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 1000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_WINDOWS", 100)
    texts = made(7)
    check(spark, texts, 40)
    (anchors, parts), (windows, more) = seen
    assert anchors == parts == -(-sum(len((t or "").encode()) for t in texts) // 1000) > 4
    assert windows == more > 4


def test_pieces_of_long_texts(spark, monkeypatch):
    from quern.llm import suffix_dedup

    r = random.Random(5)
    long = "".join(r.choice("abcd") for _ in range(9000))
    buf = np.frombuffer(long.encode(), np.uint8)
    whole = np.concatenate([np.arange(s1, s2 + 1) for _, s, e, *_ in suffix_dedup.anchors(buf, np.array([0, 9000]), 400, 256) for s1, s2 in zip(s, e, strict=True)])
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    parts = np.concatenate([np.arange(s1, s2 + 1) for _, s, e, *_ in suffix_dedup.anchors(buf, np.array([0, 9000]), 400, 256) for s1, s2 in zip(s, e, strict=True)])
    assert sorted(set(parts)) == list(whole) == list(range(8601))


def test_multikey_order():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 9, 500), r.integers(0, 9, 500)
    o = multikey_order(a, b)
    assert list(zip(a[o], b[o], strict=True)) == sorted(zip(a, b, strict=True))


def test_empty_repeated_and_null_ids(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = without_repeats(spark.createDataFrame([(1, "q" * 500), (1, "q" * 500), (None, "w" * 399), (None, None)], "doc_id long, text string")).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in rows) == [(0, 0), (399, 0), (500, 500), (500, 500)]


def test_query(spark):
    import pathlib

    sf = "/root/testdata/sf0.001"
    if pathlib.Path(sf).exists():
        docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
        ids = sorted(docs)
        want = brute([docs[i] for i in ids], 400)
        got = {r.doc_id: r for r in op1_suffix_dedup(spark, sf).collect()}
        assert [(got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) for i in ids] == [(a, b, c, hashlib.sha256(d).hexdigest()) for a, b, c, d in want]
