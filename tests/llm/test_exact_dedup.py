import hashlib

from pyspark.sql import functions as F
from quern.llm import exact_dedup as ed

ROWS = [(1, "Ab é"), (5, "aB é"), (3, "AB É"), (2, None), (4, ""), (None, ""), (6, "x" * 300_000), (7, "X" * 300_000), (8, "b"), (8, "B"), (None, "n"), (None, "N"), (9, " b")]


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def want(keep):
    out = []
    for i, t in ROWS:
        ids = [j for j, u in ROWS if low(u) == low(t)]
        known = [j for j in ids if j is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        out.append((i, best, len(ids), i == best, hashlib.sha256(low(t).encode()).hexdigest()))
    return sorted(map(repr, out))


def frame(spark):
    return spark.createDataFrame([(i, t, "k", 1) for i, t in ROWS], "doc_id long, text string, h string, norm int").repartition(3)


def test_classes(spark):
    for keep in ("smallest", "largest"):
        assert sorted(repr(tuple(r)) for r in ed.classes(frame(spark), keep=keep).collect()) == want(keep)
    assert ed.classes(frame(spark).limit(0)).collect() == []


def test_colliding_hashes_change_nothing(spark):
    weak = lambda t: F.substring(F.md5(t), 1, 0)  # noqa: E731  the same for all texts
    assert sorted(repr(tuple(r)) for r in ed.classes(frame(spark), keep="largest", content_hash=weak).collect()) == want("largest")


def test_deduplicated(spark):
    left = ed.deduplicated(frame(spark), keep="largest")
    assert left.columns == ["doc_id", "text", "h", "norm"]
    assert sorted(map(repr, (r.doc_id for r in left.collect()))) == sorted(map(repr, [5, 3, 4, 7, 8, 8, None, None, 9]))


def test_main_path_is_native(spark):
    plan = ed.classes(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_columns_that_clash(spark):
    df = spark.createDataFrame([(1, "a", 1, "x", 2), (2, "A", 1, "y", 2), (2, "b", 1, "z", 2)], "doc_id long, text string, gone int, Gone_Sha string, own_sha int")
    left = ed.deduplicated(df, keep="largest")
    assert left.columns == df.columns and sorted(r.Gone_Sha for r in left.collect()) == ["y", "z"]
