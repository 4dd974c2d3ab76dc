"""Joins by time and groups of similar keys against brute force."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from quern.operators import asof, similar

ZERO = datetime.datetime(2024, 1, 1)


def at(x):
    return None if x is None else ZERO + datetime.timedelta(seconds=x)


def sides(spark, seed=1):
    """One key has most rows; times meet, are null, or before the epoch; keys are null, or on one side only; right rows share a time."""
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    time = lambda: rng.choice([None] + [rng.randrange(-3000, 4000) for _ in range(20)])
    left = [(i, key(), time()) for i in range(300)] + [(900, "left only", 5), (901, "a", -2_000_000_000)]
    right = [(i, key(), time(), rng.randrange(5)) for i in range(200)] + [(900, "right only", 5, 1), (901, "hot", 100, 3), (902, "hot", 100, 3)]
    frame = lambda rows, cols: spark.createDataFrame([tuple(at(x) if j == 2 else x for j, x in enumerate(r)) for r in rows], cols).repartition(4)
    return left, right, frame(left, "id int, k string, t timestamp"), frame(right, "rid int, k string, ts timestamp, score int")


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("within", [None, 40])
def test_asof(spark, direction, within):
    left, right, a, b = sides(spark)

    def one(k, t):
        if t is None:
            return None
        best = None
        for rid, rk, rt, _ in right:
            if rk != k or rt is None or (within is not None and abs(rt - t) > within) or (direction == "backward" and rt > t) or (direction == "forward" and rt < t):
                continue
            rank = (-abs(rt - t), rt <= t, rid)
            best = max(best or (rank, rid), (rank, rid))
        return best and best[1]

    got = asof.asof_join(a, b, ["k"], "t", "ts", "rid", span_seconds=70, direction=direction, within_seconds=within)
    assert got.columns == ["id", "k", "t", "match"]
    assert sorted((r.id, r.match and r.match.rid) for r in got.collect()) == sorted((i, one(k, t)) for i, k, t in left)


def test_best_near(spark):
    left, right, a, b = sides(spark, 2)

    def one(k, t):
        near = [(-s, abs(rt - t), rt, rid) for rid, rk, rt, s in right if rk == k and t is not None and rt is not None and abs(rt - t) <= 120]
        return min(near)[3] if near else None

    got = asof.best_near(a, b, ["k"], "t", "ts", 120, "score", "rid").collect()
    assert sorted((r.id, r.match and r.match.rid) for r in got) == sorted((i, one(k, t)) for i, k, t in left)


def test_empty_sides(spark):
    _, _, a, b = sides(spark)
    none = asof.asof_join(a, b.limit(0), ["k"], "t", "ts", "rid").collect()
    assert len(none) == 302 and all(r.match is None for r in none)
    assert asof.asof_join(a.limit(0), b, ["k"], "t", "ts", "rid").collect() == [] == asof.best_near(a.limit(0), b, ["k"], "t", "ts", 9, "score", "rid").collect()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(keys):
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2:
                x, y = sorted([find(a), find(b)])
                root[y] = x
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("long", [40, 8, 0])
def test_groups_equal_brute_force(spark, long):
    """Edited, short, empty and unrelated keys; with pieces for keys above 8 characters, and for all."""
    rng = random.Random(3)

    def edited(s, n):
        for _ in range(n):
            i, c = rng.randrange(len(s) + 1), rng.choice("abcé")
            s = rng.choice([s[:i] + c + s[i:], s[:i] + s[i + 1 :], s[:i] + c + s[i + 1 :]])
        return s

    bases = ["".join(rng.choice("abcdefgé日") for _ in range(n)) for n in (5, 6, 7, 8, 9, 10, 11, 14, 20) for _ in range(3)]
    keys = sorted({edited(b, rng.randrange(4)) for b in bases for _ in range(6)} | {"", "x", "yy", "zzz", "zzzz"} | set(bases))
    df = spark.createDataFrame([(k,) for k in keys * 2] + [(None,)], "key string")
    assert {r.key: r.root for r in similar.groups(df, "key", long).collect()} == brute(keys)


def test_merged(spark):
    rows = [("use tabs", "2024-02-01"), ("use tabs", "2024-02-03"), ("use tbas", "2024-02-05"), ("uses tab", "2024-01-30"), ("spaces", "2024-03-01"), (None, "2024-03-01")]
    got = similar.merged(spark.createDataFrame(rows, "key string, ts string").withColumn("ts", F.to_timestamp("ts")), "key").orderBy("root").collect()
    assert [(r.spelling, r.n, r.spellings) for r in got] == [("spaces", 1, 1), ("use tabs", 4, 3)]
    assert got[1].summary == "use tabs (confirmed 4x, 2024-01-30 to 2024-02-05)"
    assert similar.merged(spark.createDataFrame([], "key string, ts timestamp"), "key").collect() == []
