"""Hard negatives against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, change=True):
    """What the contract says, with whole numbers of any size."""
    good = []
    for i, label, e in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        good.append((i, (label + 1) % 10 if change and i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in e]))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    anchors = {}
    for r in good:
        if r[0] % 100 == 0:
            anchors[r[0]] = min(anchors.get(r[0], r), r, key=lambda r: (r[1], np.array(r[2], np.float64).tobytes()))
    for a, label, v in anchors.values():
        scored = [(-dot(v, o), i, k) for i, k, o in good]
        for s, i, _ in sorted(x for x in scored if x[2] == label and x[1] != a)[:5]:
            fit = sorted(x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s)[:10]
            out += [(a, i, n + 1, j, -s, -t) for n, (t, j, _) in enumerate(fit)]
    return sorted(out)


def run(spark, rows, extra=(), **sizes):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in extra:
        df = df.withColumn(c, F.lit(1))
    u = H.usable(df.repartition(3))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = H.hard_negatives(u.select("vec_id", label.alias("label"), H.quantised(F.col("v")).alias("v")), F.col("vec_id") % 100 == 0, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def clusters(n, dims, seed, near=0.3, step=1):
    """Vectors around a centre for each label, and one vector that a tenth of all share."""
    rng = np.random.default_rng(seed)
    centres, common = rng.normal(size=(10, dims)), rng.normal(size=dims)
    labels = rng.integers(0, 10, n)
    x = centres[labels] + rng.normal(size=(n, dims)) * near
    x[rng.random(n) < 0.1] = common
    return [(i * step, int(k), [float(c) for c in v]) for i, (k, v) in enumerate(zip(labels, x, strict=True))]


@pytest.mark.parametrize("near", [0.05, 1.0])
def test_many_cells_groups_and_chunks(spark, near):
    """Tight clusters, where cells leave most rows out, and wide ones, where they can't."""
    rows = clusters(500, 8, 1, near, step=20)
    assert run(spark, rows, pivots=6, per_pivot=10, group=5, chunk=60) == brute(rows)


def test_cells_leave_rows_out(spark):
    """With tight clusters, less than half of all pairs of rows and cells are looked at."""
    rows = [(i, k, v) for i, k, v in clusters(600, 8, 2, 0.02, step=20)]
    s = H.Search(H.usable(spark.createDataFrame(rows, SCHEMA)), F.col("vec_id") % 100 == 0, pivots=8, per_pivot=10)
    any_score = s.anchors.select("vec_id", F.lit(0).cast("long").alias("band"), F.lit(-H.FAR).cast("long").alias("lo"), F.lit(H.FAR).cast("long").alias("hi"))
    seen = []
    join = s._join
    s._join = lambda asked, sent, k, same: (seen.append(sent.count()), join(asked, sent, k, same))[1]
    s.best(any_score, 5, True, "t").collect()
    assert seen[0] == 600 and seen[1] < 600 * 8 / 2


def test_edges(spark):
    """Nulls, infinite components, short and empty vectors, ties, repeated ids, negative scores, scores of 0, negative ids and labels, few rows, large whole numbers."""
    rng = random.Random(4)
    rows = [(i, i % 3, [rng.choice([-1.0, 0.0, 1.0, 0.5]) for _ in range(3)]) for i in range(0, 260, 4)]
    rows += [(1, None, [1.0, 1.0, 1.0]), (2, 1, None), (3, 1, [1.0, None, 1.0]), (5, 1, [float("nan"), 0.0, 0.0]), (6, 1, [float("inf"), 0.0, 0.0]), (None, 1, [1.0, 1.0, 1.0])]
    rows += [(9, 1, []), (11, 2, [1.0]), (100, 0, [1.0, 0.0, 1.0]), (100, 0, [1.0, 0.0, 1.0]), (13, 1, [1.0, 1.0, 1.0]), (13, 1, [1.0, 1.0, 1.0]), (-100, -4, [1.0, 1.0, -1.0]), (-3, -4, [1.0, 1.0, -1.0]), (-700, 5, [0.0, 0.0, 0.0])]
    assert run(spark, rows, extra=("v", "class", "cell", "norm2"), pivots=3, per_pivot=1, group=1, chunk=10) == brute(rows)
    rows = [(100, 1, [3e5, 2.0]), (1, 1, [2.9e5, 1.0]), (2, 2, [2e5, 77.0]), (3, 2, [2e5, 76.0]), (4, 3, [1e5, 5.0])]
    assert run(spark, rows) == brute(rows) != []


def test_too_large_and_nothing(spark):
    with pytest.raises(Exception, match="62 bits|64 bits"):
        run(spark, [(100, 1, [1e9, 0.0]), (1, 1, [1e9, 0.0])])
    assert run(spark, []) == [] == run(spark, [(1, 1, [1.0])]) == run(spark, [(100, 1, [1.0])])


def test_products_are_exact_beyond_doubles():
    a, b = np.array([[2.0**30 + 1, 3.0]]), np.array([[2.0**30 - 1, 5.0]])
    assert H._products(a, b).tolist() == [[(2**30 + 1) * (2**30 - 1) + 15]]
