"""Indexes against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import indexes, retrieval


def vectors(spark, n, dims, groups, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    x = centres[rng.integers(0, groups, n)] + rng.normal(size=(n, dims)) * 0.25
    x[:20] = x[0]  # ties
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(n, [0.0] * dims), (n + 1, None)]
    return spark.createDataFrame(rows, "id long, v array<float>")


def brute(df, queries, n):
    rows = [(r.id, np.array(r.v, np.float64)) for r in df.collect() if r.v is not None]
    out = {}
    for qid, q in queries:
        norm = np.linalg.norm(q)
        scored = [(-(x @ q) / (np.linalg.norm(x) * norm) if norm and np.linalg.norm(x) else 0.0, i) for i, x in rows]
        out[qid] = sorted((round(s, 9), i) for s, i in scored)[:n]
    return out


def test_exact_search_equals_brute_force(spark, tmp_path):
    df = vectors(spark, 1500, 8, 12, 1)
    index = indexes.VectorIndex.build(df, "id", "v", str(tmp_path / "i"), cells=20)
    rng = np.random.default_rng(2)
    queries = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(5)] + [(7, [0.0] * 8), (8, [float(x) for x in df.where("id = 3").first().v])]
    got = index.search(spark.createDataFrame(queries, "qid long, query array<double>"), 10).collect()
    want = brute(df, [(i, np.array(q)) for i, q in queries], 10)
    for qid, rows in want.items():
        mine = sorted((round(-r.score, 9), r.key) for r in got if r.qid == qid)
        assert [s for s, _ in mine] == [s for s, _ in rows]
        assert {k for s, k in mine if s < rows[-1][0]} == {k for s, k in rows if s < rows[-1][0]}


def test_vectors_are_compared_in_blocks(spark, tmp_path, monkeypatch):
    """Cells that are cut into parts, queries in several blocks, and copies, of which the least keys come first: no row is made for a pair of vectors."""
    monkeypatch.setattr(indexes, "PART", 64)
    monkeypatch.setattr(indexes, "ASKED", 8)
    monkeypatch.setattr(indexes, "STRIP", 3)
    df = vectors(spark, 600, 8, 5, 5)
    index = indexes.VectorIndex.build(df, "id", "v", str(tmp_path / "i"), cells=6)
    assert max(index.sizes) > indexes.PART
    asked = df.where("id % 20 = 0 AND v IS NOT NULL").select(F.col("id").alias("qid"), F.col("v").alias("query"))
    got = {}
    for r in index.search(asked, 10).orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append((round(r.score, 9), r.key))
    plain = asked.crossJoin(df.where("v IS NOT NULL")).select("qid", "id", F.round(retrieval.cosine(F.col("v"), F.col("query")), 9).alias("s")).collect()
    for qid, rows in got.items():
        assert rows == [(-s, i) for s, i in sorted((-r.s, r.id) for r in plain if r.qid == qid)[:10]]
    assert len(got) == asked.count() and [k for _, k in got[0]] == list(range(10))
    explained = index.search(asked, 10)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in explained and "zip_with" not in explained


def test_recall_with_a_tenth_of_the_vectors(spark, tmp_path):
    """Clustered vectors: at least 0.95 of what brute force finds, from cells that hold a tenth of all."""
    df = vectors(spark, 3000, 16, 40, 3)
    index = indexes.VectorIndex.build(df, "id", "v", str(tmp_path / "i"))
    queries = [(r.id, [float(x) for x in r.v]) for r in df.where("id % 60 = 30").collect()]
    frame = spark.createDataFrame(queries, "qid long, query array<double>")
    read = []
    join = index._first
    index._first = lambda routed, n: (read.append(routed.join(index.postings, "cell").groupBy("qid").count().agg(F.max("count")).first()[0]), join(routed, n))[1]
    got = index.search(frame, 12, share=0.1).collect()
    want = brute(df, [(i, np.array(q)) for i, q in queries], 12)
    hits = sum(len({r.key for r in got if r.qid == qid} & {k for _, k in rows}) for qid, rows in want.items())
    assert hits / sum(map(len, want.values())) >= 0.95 and read[0] <= 300


def test_no_vectors(spark, tmp_path):
    df = spark.createDataFrame([], "id long, v array<float>")
    index = indexes.VectorIndex.build(df, "id", "v", str(tmp_path / "i"))
    assert index.search(spark.createDataFrame([(1, [1.0])], "qid long, query array<double>")).collect() == []


def texts(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "Delta", "the", "the", "the", "x1", "naïve", "日本"]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", ",", ".", "-"]) for _ in range(rng.randrange(0, 60)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "rare"), (1003, "rare the rare"), (1004, "the " * 300)]
    return rows, spark.createDataFrame(rows, "id long, t string").repartition(4)


@pytest.mark.parametrize("block", [3, 1024])
def test_top_equals_whole_scan(spark, tmp_path, monkeypatch, block):
    rows, df = texts(spark)
    index = indexes.TextIndex.build(df, "id", "t", str(tmp_path / "i"), block)
    whole = df.na.fill("")
    for terms, n in ([["rare", "the"], 12], [["alpha", "beta", "the"], 5], [["the"], 12], [["Delta"], 3], [["delta", "delta"], 3], [["none"], 5], [["rare", "none", "日本", "naïve"], 8], [[], 5]):
        low = list(dict.fromkeys(t.lower() for t in terms))
        want = retrieval.keyword_pool(whole, low, "id", "t", n).collect() if terms else []
        got = index.top(terms, n).collect()
        assert [(r.key, round(r.score, 9)) for r in got] == [(r.id, round(r.score, 9)) for r in want], terms


def test_common_words_bring_no_candidates(spark, tmp_path):
    """A word that all texts hold is left to the candidates of a rare one, and blocks below the bound aren't read."""
    rows = [(i, "the " * (1 + i % 3) + ("rare rare" if i < 20 else "")) for i in range(600)]
    index = indexes.TextIndex.build(spark.createDataFrame(rows, "id long, t string"), "id", "t", str(tmp_path / "i"), 16)
    got = index.top(["rare", "the"], 5)
    assert sorted(r.key for r in got.collect())[-1] < 20


def test_phrases_equal_brute_force(spark, tmp_path):
    rows, df = texts(spark)
    index = indexes.TextIndex.build(df, "id", "t", str(tmp_path / "i"), 7)

    def count(text, said):
        tokens = re.findall(r"[^\W_]+", (text or "").lower())
        fits = lambda w, p: p == "*" or (w.startswith(p[:-1]) if p.endswith("*") else w == p)
        return sum(all(fits(w, p) for w, p in zip(tokens[i:], said, strict=False)) for i in range(len(tokens) - len(said) + 1))

    for said in ("the", "the the", "alpha * gamma", "the the the", "al* the", "the *", "* the", "x1 naïve", "the * * d*", "none", "日本 the", "*", ""):
        pieces = said.split()
        want = {i: n for i, t in rows if pieces and any(p != "*" for p in pieces) and (n := count(t, pieces))}
        assert {r.key: r.n for r in index.phrase(said).collect()} == want, said


def _shuffled(spark):
    """Bytes that the session's stages have written for shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(s.shuffleWriteBytes() for s in sc._jvm.scala.jdk.javaapi.CollectionConverters.asJava(stages))


def test_words_are_indexed_where_their_texts_lie(spark, tmp_path, monkeypatch):
    """Segments of few words, texts cut into stretches: the same answers as of one segment, and no posting is moved or written twice to build them."""
    monkeypatch.setattr(indexes, "ROWS", 5)
    monkeypatch.setattr(indexes, "STRETCH", 20)
    rows, df = texts(spark)
    none = indexes.TextIndex.build(df.limit(0), "id", "t", str(tmp_path / "none"))
    assert none.phrase("the").collect() == []
    files = str(tmp_path / "input")
    df.write.parquet(files)
    before = _shuffled(spark)
    small = indexes.TextIndex.build(spark.read.parquet(files), "id", "t", str(tmp_path / "small"), 4, segment=100)
    moved = _shuffled(spark) - before
    assert moved < 0.5 * sum(f.stat().st_size for f in (tmp_path / "small" / "postings").glob("*.parquet"))
    one = indexes.TextIndex.build(spark.read.parquet(files), "id", "t", str(tmp_path / "one"))
    assert small.postings.where("term = 'the' AND block = 0").count() > 50 > one.postings.where("term = 'the'").count()
    assert small.terms.count() == one.terms.count() == small.terms.select("term").distinct().count()
    for said in ("the the", "alpha * gamma", "al* the"):
        assert sorted(small.phrase(said).collect()) == sorted(one.phrase(said).collect())


def test_top_over_segments(spark, tmp_path):
    """The bound for blocks comes from all segments' first blocks together, each of which holds fewer texts than are asked for."""
    rows, df = texts(spark)
    index = indexes.TextIndex.build(df, "id", "t", str(tmp_path / "i"), 4, segment=100)
    assert index.postings.where("term = 'the' AND block = 0").count() > 50
    for terms, n in ((["rare", "the"], 12), (["alpha", "beta", "the"], 5), (["the"], 30)):
        want = retrieval.keyword_pool(df.na.fill(""), terms, "id", "t", n).collect()
        assert [(r.key, round(r.score, 9)) for r in index.top(terms, n).collect()] == [(r.id, round(r.score, 9)) for r in want], terms
    none = indexes.TextIndex.build(df.limit(0), "id", "t", str(tmp_path / "none"))
    assert none.top(["the"]).collect() == []


def test_segments_end_with_long_words_and_short_texts(spark, tmp_path):
    """What a task holds of a segment is bounded by characters and texts too, not by words alone; answers stay those of a whole scan."""
    long, short = [(i, f"{i:03d}" * 200) for i in range(40)], [(100 + i, "the" if i % 2 else "") for i in range(300)]
    df = spark.createDataFrame([*long, *short, (1000, "the the 001")], "id long, t string").repartition(1)
    index = indexes.TextIndex.build(df, "id", "t", str(tmp_path / "i"), segment=320)
    # one task: 40 texts of 600 characters weigh 37 words each, 301 short ones 16 each
    assert index.postings.where("length(term) = 600").count() == 40
    most = index.postings.select(F.size("entries").alias("n")).agg(F.max("n")).first()[0]
    assert most <= 20
    for terms in (["the", "001"], ["007" * 200, "the"]):
        want = retrieval.keyword_pool(df, terms, "id", "t", 5).collect()
        assert [(r.key, round(r.score, 9)) for r in index.top(terms, 5).collect()] == [(r.id, round(r.score, 9)) for r in want], terms
    assert {r.key: r.n for r in index.phrase("the").collect()} == {**{100 + i: 1 for i in range(1, 300, 2)}, 1000: 2}
