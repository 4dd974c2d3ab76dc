"""Streams replayed in many batches against batch results."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from quern.streaming import events, figures

SCHEMA = "k string, ms long, id long, v double"


@pytest.fixture
def replayed(spark, tmp_path):
    """Rows as a stream of 20 files, a file a batch."""
    rng = random.Random(1)
    rows, ms = [], 1_700_000_000_000
    for i in range(400):
        ms += rng.choice([1000, 3_600_000, 20 * 3_600_000])
        rows.append((rng.choice("aaaab") if i < 300 or rng.random() < 0.9 else "late", ms, i, rng.choice([None, rng.randrange(500) / 100])))
    for n in range(20):
        part = spark.createDataFrame(rows[n * 20 : n * 20 + 20], SCHEMA).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "in"))
    return rows, lambda: events.stream(spark, str(tmp_path / "in"), SCHEMA, 1)


def test_figures_equal_the_batch(spark, tmp_path, replayed):
    rows, stream = replayed
    out = str(tmp_path / "out")
    figures.kept_figures(stream(), "k", "ms", "id", "v", out, str(tmp_path / "log"))
    saved = spark.read.parquet(out)
    assert saved.select("batch").distinct().count() == 20
    last = saved.groupBy("key").agg(F.max_by(F.struct("n", "latest_id", "latest_value", "median"), "batch").alias("x")).select("key", "x.*").collect()
    for r in last:
        mine = [x for x in rows if x[0] == r.key]
        values = [x[3] for x in mine if x[3] is not None]
        assert (r.n, r.latest_id, r.latest_value, round(r["median"], 6)) == (len(values), mine[-1][2], mine[-1][3], round(statistics.median(values), 6))
    assert len(last) == len({x[0] for x in rows})


def test_tiers_equal_the_batch(spark, tmp_path, replayed):
    """Gaps of five days are warm, of ten days cold; the last tiers come from timers."""
    rows, stream = replayed
    out = str(tmp_path / "out")
    figures.kept_tiers(stream().withColumn("ts", F.timestamp_millis("ms")), "k", "ts", out, str(tmp_path / "log"), 5, 10)
    got = sorted((r.key, r.since, r.tier) for r in spark.read.parquet(out).collect())
    end, want = max(x[1] for x in rows), []
    for k in {x[0] for x in rows}:
        times = sorted(x[1] for x in rows if x[0] == k)
        want.append((k, times[0], "HOT"))
        for a, b in zip(times, [*times[1:], None], strict=True):
            until = b - 1 if b is not None else end - 1
            reached = [(k, a + d * figures.DAY_MS, tier) for tier, d in (("WARM", 5), ("COLD", 10)) if a + d * figures.DAY_MS <= until]
            want += reached + ([(k, b, "HOT")] if reached and b is not None else [])
    assert got == sorted(want) and {t for _, _, t in got} >= {"HOT", "WARM"}
