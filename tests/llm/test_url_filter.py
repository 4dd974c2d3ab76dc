import math

import numpy as np
from quern.llm import url_filter as uf


def rule_of(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), h + p, v) for h, p, v in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = [
    "http://a.example.com/en/1", "https://www.example.com/en/x?q=1", "HTTP://WWW.Example.COM/en/", "http://example.com/EN/1", "http://x.net/es/1#a", "http://net/fr/", "http://x.net/de/3", "http://xnet/es/1",
    "http://com", "http://com/", "ftp://u@b.com:8/p/?/#", "no scheme/en/", "://", "http://é.com/\n/x?", "http://a.b/c://d.com/e", "http://example.com?x=/en/", "", None, "http://" + "a" * 9000 + ".com/p", "http://m.www.example.com/en/é",
]


def test_rules_and_parts(spark):
    df = spark.createDataFrame([(i, u, "k", 2.0) for i, u in enumerate(URLS)] + [(None, URLS[0], "k", 2.0), (0, URLS[0], "k", 2.0)], "page_id long, url string, rule string, score double")
    rows = uf.filtered(df).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        host, path, rule, verdict = rule_of(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert uf.filtered(df.limit(0)).collect() == []


def test_model_tells_kinds_apart():
    rng = np.random.default_rng(1)
    make = lambda words: [f"http://{rng.choice(words)}{rng.integers(99)}.org/{rng.choice(words)}/{rng.integers(999)}".encode() for _ in range(400)]
    good, bad = make(["garden", "library", "science"]), make(["casino", "jackpot", "pills"])
    ratio = uf.Ratio(good[:300], bad[:300])
    assert np.mean(ratio.scores(good[300:]) >= ratio.threshold) > 0.97
    assert np.mean(ratio.scores(bad[300:]) < ratio.threshold) > 0.97


def test_markov_model_is_a_distribution():
    m = uf.Markov([b"abcab", b"abd", b"zz"])
    total = sum(math.exp(m.log(*uf._joined([b"ab" + bytes([c])]))[2]) for c in range(256))
    assert abs(total - 1) < 1e-9


def test_rules_of_one_kind(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [r.verdict for r in uf.filtered(df).collect()] == ["allow"]


def test_models_learn_from_all_ruled_urls(spark, monkeypatch):
    urls = [f"http://a{i}.com/p/{i}" for i in range(3000)] + [f"http://b{i}.net/{'es' if i % 2 else 'fr'}/{i}" for i in range(3000)] + ["http://long.net/es/" + "z" * 3000] + ["http://c.org/q", None, ""]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    known = uf.ruled(df, uf.RULES).where("ruling is not null").selectExpr("url", "ruling = 'allow' AS good")
    seen, real = [], uf.Markov.of.__func__
    monkeypatch.setattr(uf.Markov, "of", classmethod(lambda cls, g, c: seen.append(real(cls, g, c)) or seen[-1]))
    held = {r.url for r in known.where("pmod(xxhash64(url), 4) = 3").collect()}
    got = {r.page_id: (r.verdict, r.score) for r in uf.filtered(df).collect()}
    for model, good in zip(seen, (True, False), strict=True):
        want = uf.Markov([r.url.encode() for r in known.where(f"good = {good}").collect() if r.url not in held])
        for name in ("grams", "gram_counts", "contexts", "context_counts", "kinds"):
            assert np.array_equal(getattr(model, name), getattr(want, name)), name
    monkeypatch.setattr(uf, "BROADCAST_ROWS", 0)
    few = df.where("page_id % 50 = 0 or page_id > 6000")
    joined = {r.page_id: (r.verdict, r.score) for r in uf.filtered(few).collect()}
    monkeypatch.setattr(uf, "BROADCAST_ROWS", 1 << 20)
    for r in uf.filtered(few).collect():
        assert joined[r.page_id][0] == r.verdict and abs(joined[r.page_id][1] - r.score) < 1e-9
    assert len(got) == len(urls)
