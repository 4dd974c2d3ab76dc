"""Batches of keys that spread over blocks against the fold."""

import random

import pytest
from pyspark.sql import functions as F

from quern.operators import batching, segments


def both(spark, rows, budget, long, block):
    df = spark.createDataFrame(rows, "k string, i int, n int").repartition(8)
    run = lambda **o: sorted((r.k or "", r.i, r.n or 0, r.batch_id) for r in batching.greedy_batches(df, "k", ["i"], F.col("n"), budget, **o).collect())
    return run(long=long, block=block), run(long=1 << 30)


@pytest.mark.parametrize(("sizes", "budget", "block"), [(range(0, 40), 100, 16), ([0, 0, 0, 1, 150, 0], 100, 7), ([0], 1, 5), ([200, 300], 100, 9), ([1], 50, 8), ([0, 1, 99, 100, 101], 100, 3), ([3], 1000, 10)])
def test_blocks_equal_the_fold(spark, sizes, budget, block):
    """Sizes of 0, above the budget, batches that span whole blocks, blocks that open none; short keys beside long ones, null key and sizes."""
    rng = random.Random(block)
    rows = [("hot", i, rng.choice(list(sizes))) for i in range(700)] + [(None, i, rng.choice([*sizes, None])) for i in range(90)] + [(f"k{i % 9}", i, rng.choice(list(sizes))) for i in range(60)]
    got, want = both(spark, rows, budget, 50, block)
    assert got == want and len(got) == len(rows)


def test_one_document_spreads_over_tasks(spark, tmp_path):
    """No task of the last stage holds more than a quarter of the rows of a single document."""
    df = spark.range(16000).select(F.lit("doc").alias("k"), F.col("id").alias("i"), (F.col("id") * 7919 % 97).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = batching.greedy_batches(df, "k", ["i"], F.col("n"), 1200, long=1000, block=500)
        counts = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(counts) == 16000 and max(counts) <= 4000


def test_sentences_as_rows(spark):
    text = "".join(f"Sentence {i} {'word ' * (i % 60)}." + ("」 " if i % 7 == 0 else " ") for i in range(400)) + "no mark at the end"
    docs = spark.createDataFrame([("a", text), ("b", "One! Two? 三。"), ("c", " "), ("d", None)], "doc string, text string")
    said = docs.select("doc", F.posexplode(segments.sentences(F.col("text"))).alias("pos", "s"))
    want = segments.numbered(docs.select("doc", segments.packed_sentences(F.col("text")).alias("p")), F.col("p"), "doc")
    got = batching.packed_rows(said, "doc", "pos", "s", segments.PIECE, long=100, block=40)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_sentences_are_cut_once_and_moved_once(spark, monkeypatch):
    """Sentences come from one pass, in slices, as the array expression gives them; those of short documents go through one shuffle, and keys may be null."""
    monkeypatch.setattr(segments, "SLICE", 50)
    monkeypatch.setattr(batching, "SLICE", 50)
    text = "One!\x85 Two?\xa0三。　 \x1c four… " + "five words of it" * 20 + "! \t」x"
    docs = spark.createDataFrame([(1, text), (2, None), (3, " !  "), (None, text + "six"), (4, ""), (5, text * 30)], "doc int, text string")
    said = segments.sentence_rows(docs, "doc", "text")
    plain = docs.select("doc", F.posexplode(segments.sentences(F.col("text"))).alias("pos", "s"))
    key = lambda r: (r.doc or 0, r[1])
    assert sorted(said.collect(), key=key) == sorted(plain.collect(), key=key)
    got = batching.packed_rows(said, "doc", "pos", "s", 40)
    want = batching.packed_rows(plain, "doc", "pos", "s", 40, long=2, block=3)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    planned = got._jdf.queryExecution().optimizedPlan().toString()
    assert planned.count("RepartitionByExpression") == 1 and "Aggregate" not in planned
