"""The mix against a brute-force version, and its schedules against numeric integration."""

import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quern.llm import mixing

SCHEMA = "doc_id long, source string, text string"


def filled(sizes, weights, epochs=3):
    """Targets by resharing the excess until none is above."""
    total, full = Fraction(sum(sizes)), set()
    while True:
        rest, w = total - sum(epochs * sizes[i] for i in full), sum(weights[i] for i in range(len(sizes)) if i not in full)
        out = [Fraction(epochs * sizes[i]) if i in full else rest * weights[i] / w for i in range(len(sizes))]
        above = {i for i in range(len(sizes)) if i not in full and out[i] > epochs * sizes[i]}
        if not above:
            return out
        full |= above


def count(text):
    return len([w for w in "".join(" " if ch in "\t\n\x0b\x0c\r" else ch for ch in text or "").split(" ") if w])


def check(docs, rows, weights=(5, 2, 1)):
    by = defaultdict(list)
    for doc_id, source, text in docs:
        by[source].append((doc_id, count(text)))
    order = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + ([None] if None in by else [])
    sizes = [sum(n for _, n in by[s]) for s in order]
    target = dict(zip(order, filled(sizes, [weights[i % len(weights)] for i in range(len(order))]), strict=True))
    assert len(rows) == len(docs)
    got = defaultdict(list)
    for r in rows:
        got[r.source].append(r)
    for s in order:
        size, want = sum(n for _, n in by[s]), target[s]
        assert sorted((repr(r.doc_id), r["size"]) for r in got[s]) == sorted((repr(d), n) for d, n in by[s])
        assert all(r.source_size == size and abs(r.target - float(want)) <= 1e-9 * max(1, float(want)) for r in got[s])
        assert abs(sum(r.taken for r in got[s]) - float(want)) <= 0.5 + 1e-6 and all(0 <= r.taken <= 3 * r["size"] for r in got[s])
        # whole passes in a fixed order, the last one cut
        before, expected = 0, {}
        key = lambda x: (x[0] is not None, hashlib.md5(str(x[0]).encode()).hexdigest() if x[0] is not None else "", x[0] or 0, x[1])  # noqa: E731, S324
        left = []
        for d, n in sorted(by[s], key=key):
            left.append((repr(d), n, sum(max(0, min(n, round(float(want)) - p * size - before)) for p in range(3))))
            before += n
        assert sorted((repr(r.doc_id), r["size"], r.taken) for r in got[s]) == sorted(left), expected


def test_mix_against_brute_force(spark):
    """Sources of one short document, without words, null, of a third of all rows; ids that repeat or are null; very long texts; clashing columns."""
    rng = random.Random(3)
    docs = [(i, "hot" if i % 3 == 0 else f"s{i % 9}", "w " * rng.randrange(0, 60)) for i in range(600)]
    docs += [(1000, "one", "a b c"), (1001, "Ünï", "x " * 20000), (1002, None, "a b"), (1003, None, None), (1004, "empty", ""), (1005, "empty", " \t\n"), (7, "s7", "again"), (7, "s7", "again"), (None, "s1", "a b c")]
    docs += [(2000, "\U0001f600", "emoji first"), (2001, "￮", "below it by code point")]
    df = spark.createDataFrame(docs, SCHEMA).repartition(5).withColumns({c: F.lit(1) for c in ("size", "_place", "pieces", "position", "target")})
    run = lambda frame: mixing.curriculum(frame, by_rank=mixing.fading()).collect()
    rows = run(df)
    check(docs, rows)
    assert sorted(map(repr, rows)) == sorted(map(repr, run(df.repartition(3))))  # reruns agree, however rows are dealt


def test_excess_is_reshared_again_and_again(spark):
    docs = [(i, s, "w " * n) for i, (s, n) in enumerate([("a", 1), ("b", 100), ("c", 2), ("d", 3), ("e", 400), ("f", 5), ("g", 2000), ("h", 9), ("i", 7)])]
    check(docs, mixing.curriculum(spark.createDataFrame(docs, SCHEMA), by_rank=mixing.fading()).collect())


def test_nothing(spark):
    assert mixing.curriculum(spark.createDataFrame([], SCHEMA), by_rank=mixing.fading()).collect() == []
    rows = mixing.curriculum(spark.createDataFrame([(1, "a", ""), (2, None, None)], SCHEMA), by_rank=mixing.fading()).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in rows] == [(0, 0, 0.0, 0)] * 2


@pytest.mark.parametrize("knots", [[(0, 1), (1, 1)], [(0, 3), (1, 1)], [(0, 0), (1, 2)], [(0, 0), (0.25, 4), (0.5, 0), (0.75, 0), (1, 1)], [(0, 1), (0.1, 0), (0.9, 0), (1, 1)]])
def test_demand_is_inverted(spark, knots):
    """The integral up to time_of(share) is that share of the whole."""

    def demand(t):
        area = 0.0
        for (a, v), (b, w) in zip(knots, knots[1:], strict=False):
            to = min(max(t, a), b)
            area += (v + v + (w - v) * (to - a) / (b - a)) / 2 * (to - a)
        return area

    pieces = mixing.schedule(knots)
    rows = spark.range(0, 101).select((F.col("id") / 100).alias("s"), mixing.time_of(F.col("id") / 100, pieces).alias("t")).collect()
    assert all(abs(demand(r.t) / demand(1) - r.s) < 1e-9 for r in rows)
    assert all(a.t <= b.t for a, b in zip(rows, rows[1:], strict=False))


def test_the_mixture_varies_over_training(spark):
    """A source that fades has more of its words early, one that rises more of them late; documents come by position, none twice before its turn."""
    docs = [(i, "ab"[i % 2], "w " * 10) for i in range(2000)]
    schedules = spark.createDataFrame([("a",), ("b",)], "source string").withColumn("pieces", F.when(F.col("source") == "a", mixing.schedule([(0, 2), (1, 0)])).otherwise(mixing.schedule([(0, 0), (1, 2)])))
    mix = mixing.curriculum(spark.createDataFrame(docs, SCHEMA), schedules)
    order = mixing.training_order(mix).collect()
    assert [r.position for r in order] == sorted(r.position for r in order) and sum(r.words for r in order) == 20000
    half = [r for r in order if r.position < 0.5]
    assert abs(sum(r.source == "a" for r in half) / 1000 - 0.75) < 0.01 and abs(sum(r.source == "b" for r in half) / 1000 - 0.25) < 0.01
    assert mixing.curriculum(spark.createDataFrame(docs, SCHEMA), schedules.where("source = 'a'")).where("source = 'b' AND taken > 0").count() == 0


def test_sources_may_be_joined(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    docs = [(i, f"s{i % 5}" if i % 4 else None, "w " * (i % 11)) for i in range(300)]
    check(docs, mixing.curriculum(spark.createDataFrame(docs, SCHEMA), by_rank=mixing.fading()).collect())
