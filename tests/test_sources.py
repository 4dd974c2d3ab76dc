import datetime
import io
import json
import zipfile

from quern.sources import readers
from quern.streaming import events


def word_file(path):
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    body = p("First one") + "<w:tbl><w:tr><w:tc>" + p("x") + "</w:tc><w:tc>" + p("y") + "</w:tc><w:tc><w:p/></w:tc></w:tr></w:tbl>" + p("Last one")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
    path.write_bytes(out.getvalue())


def test_reading_by_suffix(spark, tmp_path):
    word_file(tmp_path / "a.docx")
    (tmp_path / "b.txt").write_text("One.\n\n\nTwo &amp; three.")
    (tmp_path / "c.html").write_text("<style>p{}</style><p>Hi</p><p>there</p>")
    (tmp_path / "d.json").write_text(json.dumps({"language": "en", "segments": [{"start": 0, "end": 1, "text": "a"}, {"text": " "}, {"id": 9, "text": "b"}]}))
    (tmp_path / "e.json").write_text(json.dumps({"title": "t", "n": 1}))
    said = lambda name, kind=None: [(r.id, r.text) for r in readers.read(spark, str(tmp_path / name), kind).collect()]
    assert said("a.docx") == [(1, "First one"), (2, "Last one"), (3, "x | y")]
    assert said("b.txt") == [(1, "One."), (2, "Two & three.")]
    assert [t for _, t in said("c.html")] == ["Hi", "there"]
    assert said("d.json") == [(1, "a"), (9, "b")] == said("d.json", "transcript")
    assert [t for _, t in said("e.json")] == ['"title": "t",\n"n": 1'] or "title" in said("e.json")[0][1]
    assert {r.kind for r in readers.read(spark, str(tmp_path / "d.json"), "ocr").collect()} == {"ocr"}


def test_subtitles_prefer_vtt(spark, tmp_path):
    (tmp_path / "a.srt").write_text("1\n00:00:01,000 --> 00:00:02,000\nsrt")
    (tmp_path / "b.vtt").write_text("WEBVTT\n\n00:00:01.000 --> 00:00:02.000\nvtt")
    assert [r.text for r in readers.subtitles(spark, str(tmp_path)).collect()] == ["vtt"]


def test_logs_models_counters_checkpoint_config(spark, tmp_path):
    (tmp_path / "run").mkdir()
    (tmp_path / "run" / "x.wandb").write_bytes(b"steps: 5/10 avr_loss=0.5")
    (tmp_path / "run" / "x.txt").write_bytes(b"no")
    assert [r.path.rsplit("/", 1)[1] for r in readers.logs(spark, str(tmp_path)).collect()] == ["x.wandb"]
    (tmp_path / "m.json").write_text('[{"name": "a", "cost_score": 1, "capabilities": ["chat"]}, {"name": "b"}]')
    assert [(r.pos, r.name, r.cost_score) for r in readers.models(spark, str(tmp_path / "m.json")).collect()] == [(0, "a", 1.0), (1, "b", None)]
    c = spark.createDataFrame([('[{"Path": "p", "CookedValue": 2.5}, {"Path": "q"}]',)], "j string")
    assert [tuple(r) for r in readers.counters(c, "j").collect()] == [("p", 2.5), ("q", 0.0)]
    assert readers.checkpoint(spark, str(tmp_path / "none")) is None
    (tmp_path / "c.toml").write_text("[a]\nb = 1\n")
    assert readers.config(spark, str(tmp_path / "c.toml")) == {"a": {"b": 1}}


def test_writing_text(spark, tmp_path):
    readers.write_text(spark.createDataFrame([("d", "hello"), ("e", "")], "doc string, t string"), str(tmp_path / "o"), "doc", "t")
    assert sorted(p.name for p in (tmp_path / "o").iterdir() if p.is_dir()) == ["doc=d"]


def test_streams(spark, tmp_path):
    day = lambda d: datetime.datetime(2024, 1, d)
    df = spark.createDataFrame([(i, day(1 + i % 9), "view" if i % 2 else "click") for i in range(60)], "event_id int, ts timestamp, event_type string")
    df.write.parquet(str(tmp_path / "in"))
    counted = events.windowed_counts(events.stream(spark, str(tmp_path / "in"), df.schema), "event_type")
    events.run_available(counted, str(tmp_path / "out"), str(tmp_path / "ck"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert 0 < sum(r.n for r in out.collect()) <= 60 and out.groupBy("start", "event_type").count().where("count > 1").count() == 0
    seen = []
    for _ in range(2):
        events.run_batches(events.stream(spark, str(tmp_path / "in"), df.schema), lambda batch, n: seen.append(batch.count()), str(tmp_path / "ck2"))
    assert sum(seen) == 60
