import json
import socket
import time

import pytest
from pyspark.sql import functions as F

from quern.operators import adapters, translate
from quern.plans import runs
from quern.sources import readers


def test_translation_run_and_resume(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("One.\n\nTwo.")
    out = str(tmp_path / "out")
    (row,) = runs.translation_run(spark, str(tmp_path / "in"), out, "text").collect()
    assert (row.segments, row.timed) == (2, 0)
    assert spark.read.parquet(f"{out}/translated").first().translated == "[zh] One.\n[zh] Two."
    again = runs.translation_run(spark, str(tmp_path / "in"), out, "text", translator=lambda *a: pytest.fail("all is known"))
    assert again.first().segments == 2


def test_third_run_sends_only_what_is_new(spark, tmp_path):
    folder, out, sent = tmp_path / "in", str(tmp_path / "out"), tmp_path / "sent"
    folder.mkdir()
    sent.mkdir()

    def translator(text, source, target):
        (sent / str(abs(hash(text)))).write_text(text)
        return f"[zh] {text}"

    for name in "abc":
        (folder / f"{name}.txt").write_text(f"Text {name}.")
        for f in sent.iterdir():
            f.unlink()
        rows = runs.translation_run(spark, str(folder), out, "text", translator=translator).collect()
        assert [f.read_text() for f in sent.iterdir()] == [f"Text {name}."]
    assert len(rows) == 3 and rows[0].mode == "translated" and rows[0].segments_path.endswith("/segments/v00000003")
    assert [p.name for p in (tmp_path / "out/segments").iterdir()] == ["v00000003"]


def test_a_killed_run_goes_on_in_the_middle(spark, tmp_path):
    """A run that dies after half of its documents has saved them; the next one sends the others only, and nothing is lost or sent twice."""
    folder, out, sent = tmp_path / "in", str(tmp_path / "out"), tmp_path / "sent"
    folder.mkdir()
    sent.mkdir()
    for i in range(12):
        (folder / f"{i:02d}.txt").write_text(f"Text {i}.\n\nMore of {i}.")

    def translator(most):
        def run(text, source, target):
            if len(list(sent.iterdir())) >= most:
                raise RuntimeError("killed")
            (sent / f"{text.split('.')[0].strip()}-{time.time_ns()}").write_text(text)
            return "\n".join(f"[zh] {line}" if line.strip() and translate.SEPARATOR not in line else line for line in text.split("\n"))

        return run

    go = lambda most: runs.translation_run(spark, str(folder), out, "text", saves=6, per_save=2, attempts=1, translator=translator(most)).collect()
    with pytest.raises(Exception, match="killed"):
        go(6)
    parts = sorted(p.name for p in (tmp_path / "out/segments/v00000001").iterdir() if p.name.startswith("part="))
    whole = [p for p in parts if (tmp_path / f"out/segments/v00000001/{p}/_SUCCESS").exists()]
    assert whole and not (tmp_path / "out/segments/v00000001/_SUCCESS").exists()
    saved = {r.doc for r in spark.read.parquet(*(str(tmp_path / f"out/segments/v00000001/{p}") for p in whole)).collect()}
    before = {f.name for f in sent.iterdir()}
    assert len(saved) >= 3 and len(before) == 6
    rows = go(1000)
    assert len(rows) == 12 and all(r.segments == 2 for r in rows)
    later = [f.read_text() for f in sent.iterdir() if f.name not in before]
    assert len(later) == 12 - len(saved)  # a document each
    assert not any(f"Text {int(d.rsplit('/', 1)[1][:2])}." in t.split("\n") for d in saved for t in later)
    assert spark.read.parquet(rows[0].segments_path).where("translation LIKE '[zh] %'").count() == 24
    assert readers.folders(spark, f"{out}/running") == [] and [p.name for p in (tmp_path / "out/segments").iterdir()] == ["v00000002"]


def test_without_resume_a_stopped_run_is_thrown_away(spark, tmp_path):
    segments = spark.createDataFrame([(f"d{i}", 1, f"text {i}") for i in range(8)], "doc string, id long, text string")
    with pytest.raises(Exception, match="division by zero"):
        runs.saved_translations(segments, str(tmp_path), saves=4, per_save=1, attempts=1, translator=lambda *a: 1 / 0 if "text 5" in a[0] else a[0])
    assert readers.folders(spark, f"{tmp_path}/running") == ["v00000001"]
    path = runs.saved_translations(segments, str(tmp_path), saves=4, per_save=1, resume=False)
    assert path.endswith("v00000001") and spark.read.parquet(path).count() == 8 and readers.folders(spark, f"{tmp_path}/running") == []


def test_broken_checkpoints_are_no_obstacle(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("One.")
    out = str(tmp_path / "out")
    runs.translation_run(spark, str(tmp_path / "in"), out, "text")
    assert readers.checkpoint(spark, f"{out}/segments").count() == 1
    half = tmp_path / "out/segments/v00000009"  # a run that stopped: there is no mark of success
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"PAR1")
    assert readers.checkpoint(spark, f"{out}/segments").count() == 1
    for f in (tmp_path / "out/segments/v00000001").glob("*.parquet"):
        f.write_bytes(f.read_bytes()[:40])
    for f in (tmp_path / "out/segments/v00000001").glob(".*.crc"):
        f.unlink()
    (row,) = runs.translation_run(spark, str(tmp_path / "in"), out, "text").collect()
    assert row.segments == 1 and readers.checkpoint(spark, str(tmp_path / "nowhere")) is None


def test_latest_and_baseline_in_one_pass(spark):
    from quern.operators import progress

    rows = [("u", p, n, s, 100, 1.0, v, r, float(s)) for u, (p, n, s, v, r) in enumerate([("a", 0, 10, 2.0, None), ("a", 1, 30, None, 90.0), ("b", 0, 60, 4.0, 1.0), ("b", 1, 30, 9.0, 5.0), ("c", 0, 30, 9.0, 5.0), ("c", 1, 5, 9.0, 5.0)])]
    m = spark.createDataFrame(rows, "run string, path string, nth int, step long, total long, loss double, sec_per_step double, runtime double, ts double")
    want = progress.latest_record(m, "run").join(progress.median_baseline(m, "run"), "run").collect()
    assert progress.latest_and_baseline(m, "run").collect() == want
    assert progress.latest_and_baseline(m.drop("run").limit(0)).collect() == []


def test_timed_run_writes_subtitles(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"segments": [{"start": 0, "end": 1.5, "text": "a"}, {"start": 2, "end": 3, "text": "b"}]}))
    runs.translation_run(spark, str(tmp_path / "t.json"), str(tmp_path / "out"), "transcript", mode="bilingual", refiner=translate.offline_refiner)
    assert spark.read.parquet(str(tmp_path / "out/subtitles")).first().srt == "1\n00:00:00,000 --> 00:00:01,500\na\n[zh] a\n\n2\n00:00:02,000 --> 00:00:03,000\nb\n[zh] b\n"


def test_progress_line(spark):
    files = spark.createDataFrame([("a", bytearray(b"steps: x 20/100 [2.0s/it, avr_loss=0.25]"))], "path string, content binary")
    device = spark.createDataFrame([(60, 100, 40)], "dedicated_used_mb long, dedicated_total_mb long, dedicated_free_mb long")
    assert runs.progress_line(files, "run", device).first().line == "run | 20/100 | 20.0% | avr_loss 0.250 | ETA 2m40s | VRAM 60/100MB | speed x1.00 | risk high | running"


def test_profiles_and_positional_merge(spark, one):
    assert [one(lambda c: runs.profile_setting(c, {"fast": "small"}, "medium"), p) for p in ("fast", "odd", None)] == ["small", "medium", "medium"]
    batch = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos int, translation string")
    lines = spark.createDataFrame([(0, "A"), (1, " "), (3, "x")], "pos int, line string")
    assert [r.translation for r in runs.positional_merge(batch, lines).orderBy("pos").collect()] == ["A", "b", "c"]


def test_adapters():
    server = socket.create_server(("127.0.0.1", 0))

    url = f"http://127.0.0.1:{server.getsockname()[1]}"
    assert adapters.when_ready(lambda b: "ok", url)([]) == "ok"
    server.close()
    with pytest.raises(TimeoutError, match="not ready within"):
        adapters.wait_ready("http://127.0.0.1:1", timeout=0.2, pause=0.1)
    assert adapters.paced(lambda x: x + 1, 1)(1) == 2


def test_failure_status(one):
    assert [one(translate.failure_status, m) for m in ("Not ready within 10s", "read timed out", "odd")] == ["not_ready", "timeout", "failed"]
    assert one(lambda c: F.size(F.split(c, ",")), "a,b", kind="string") == 2
