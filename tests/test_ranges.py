"""Log files read by ranges against whole files; medians over ranges."""

import random
import re
import statistics
import time

import pytest
from pyspark.sql import functions as F

from quern.operators import adapters, progress
from quern.sources import ranges


def log(seed, n=400):
    """Lines with and without matches: nested and broken beginnings, line ends behind a beginning, binary bytes, matches without a gap."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        match = f"steps: {rng.choice(['', '40%|## ', 'steps: ', chr(10) + '  '])}{i}/{n} [{rng.choice(['3.5s/it, ', ''])}avr_loss={i / 7:.3f}".encode()
        out.append(rng.choice([match, match + b"]", b"steps:", b"steps:\n\n", b"steps: 5/6 ", b"\n", b"\r\n", b"_runtime: 12.5", b"_timestamp\x00 17", rng.randbytes(rng.randrange(90)), b"avr_loss=1", b" " * rng.randrange(40), match + match]))
    return b"".join(out)


@pytest.mark.parametrize("seed", range(6))
def test_ranges_find_what_a_whole_search_finds(seed, monkeypatch):
    monkeypatch.setattr(ranges, "STEP_BYTES", 700)
    data = log(seed)
    want = [(m.start(), m[0]) for m in re.finditer(progress.STEP, data)]
    for size in (1, 7, 64, 333, 1000, len(data)) if seed == 0 else (64, 333, 5000):
        got = []
        for a in range(0, len(data), size):
            got += [(p, m[0]) for p, m, _ in ranges.matches(lambda x, y: data[x:y], a, min(len(data), a + size), len(data))]
        assert got == want and len(want) > 30, size


def test_a_file_cut_in_eight_equals_the_whole(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"{i}.wandb").write_bytes(log(10 + i, 1500))
    (tmp_path / "empty.wandb").write_bytes(b"")
    (tmp_path / "other.txt").write_bytes(log(3))
    size = max((tmp_path / f"{i}.wandb").stat().st_size for i in range(2))
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "*.wandb").load(str(tmp_path)).select("path", "content")
    name = F.regexp_extract("path", r"([^/]*)$", 1).alias("path")
    columns = ["nth", "step", "total", "loss", "sec_per_step", "runtime", "ts"]
    want = sorted(map(repr, progress.log_matches(whole).select(name, *columns).collect()))
    for path in (str(tmp_path), f"file://{tmp_path}"):
        cut = ranges.log_matches(spark, path, range_bytes=size // 8 + 1)
        assert sorted(map(repr, cut.select(name, *columns).collect())) == want and len(want) > 200
    read = spark.read.format("log_ranges").option("path", str(tmp_path)).option("rangeBytes", size // 8 + 1).option("pattern", "0.wandb").load()
    assert read.rdd.getNumPartitions() in (8, 9)
    assert ranges.log_matches(spark, str(tmp_path), "none*").collect() == []


def test_medians_over_ranges(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.choice([None, rng.random(), 0.5])) for _ in range(501)] + [("one", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: r["median"] for r in progress.exact_medians(df, ["k"], "v").collect()}
    want = {k: statistics.median(x for j, x in rows if j == k and x is not None) for k in {k for k, v in rows if v is not None}}
    assert got == want
    assert progress.exact_medians(df, [], "v").first()["median"] == statistics.median(x for _, x in rows if x is not None)
    assert progress.exact_medians(df.limit(0), ["k"], "v").collect() == [] == progress.exact_medians(df.limit(0), [], "v").collect()


def test_spread_baseline_equals_the_median(spark):
    rng = random.Random(6)
    rows = [(f"r{i % 3}", rng.randrange(100), rng.choice([None, rng.random()]), rng.choice([None, 0.0, rng.random() * 90])) for i in range(400)]
    m = spark.createDataFrame(rows, "run string, step long, sec_per_step double, runtime double")
    assert sorted(map(tuple, progress.spread_baseline(m, "run").collect())) == sorted(map(tuple, progress.median_baseline(m, "run").collect()))


def test_pace_is_shared(spark, tmp_path):
    """With two streams, each call waits twice as long; no more than two tasks translate."""
    from quern.operators import translate

    began = time.monotonic()
    adapters.paced(lambda x: x, 20, streams=3)(1)
    assert time.monotonic() - began >= 0.06
    rows = spark.createDataFrame([(f"d{i}", 1, "x") for i in range(40)], "doc string, id long, text string")
    out = translate.translate_documents(rows, "doc", translator=adapters.paced(translate.offline_translator, 1, 2), streams=2)
    assert out.rdd.getNumPartitions() == 2 and out.count() == 40


def test_short_ranges_share_tasks():
    """Ten files of 1 GB by ranges of 128 KB come in tasks of 32 MB; a few ranges in a task each."""
    spans = [ranges.Span("f", i << 17, (i + 1) << 17, 1 << 30) for i in range(1 << 13)]
    tasks = ranges.dealt(spans * 10, 1 << 17)
    assert len(tasks) == 320 and [s for t in tasks for s in t.spans] == spans * 10
    assert [len(t.spans) for t in ranges.dealt(spans[:50], 1 << 17)] == [1] * 50 and len(ranges.dealt(spans[:3], 1 << 30)) == 3
