import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F
from quern.llm import quality, toxicity
from quern.llm.common import Fingerprints


def made(n=600, seed=1):
    """Documents, a third toxic by one sentence with a bad stem; a third junk; labels for most."""
    r = random.Random(seed)
    syllables = ["ba", "lo", "mi", "ken", "tar", "sol", "wi", "ru", "é"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    sentence = lambda: " ".join(word() for _ in range(r.randint(3, 12)))
    docs, labels = [], []
    for i in range(n):
        parts = [sentence() for _ in range(r.randint(1, 12))]
        toxic, junk = r.random() < 0.33, r.random() < 0.33
        if toxic:
            bad = r.choice(["grumblex", "vilesnort", "Grumblex"]) + r.choice(["", word()])
            at = r.randrange(len(parts))
            parts[at] += " " + bad + " " + word() + " vilesnort"
        text = ". ".join(parts)
        if junk:
            text = " ".join(w + r.choice(["###", "$$$"]) for w in text.split())
        docs.append((i, text, "k", 0.5))
        if r.random() < 0.9:
            labels.append((i, int(not junk), int(toxic)))
    docs += [(n, None, "k", 0.5), (None, "plain words here", "k", 0.5), (n + 1, "", "k", 0.5), (0, docs[0][1], "k", 0.5), (n + 2, "ba lo mi. " * 30000 + "you grumblex vilesnort", "k", 0.5)]
    return docs, [*labels, (None, 1, 1), (3, None, None)]


DOCS, LABELS = "doc_id long, text string, y string, score double", "doc_id long, quality int, toxic int"


def test_held_out_accuracy_and_bounds(spark):
    docs, labels = made()
    d, l = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    truth = {i: (q, t) for i, q, t in labels if i is not None and q is not None}
    for judged, which, folds, fold, least in ((toxicity.judged, 1, 3, 1, 0.7), (quality.judged, 0, 5, 0, 0.3)):
        rows = judged(d, l).collect()
        assert len(rows) == len(docs)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= least) for r in rows)
        assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in rows)
        right = [r.predicted == truth[r.doc_id][which] for r in rows if r.held_out and r.doc_id in truth]
        assert np.mean(right) > 0.95
        assert sorted(map(repr, rows)) == sorted(map(repr, judged(d.repartition(7), l.repartition(3)).collect()))


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = made(300)
    d = spark.createDataFrame(docs, DOCS)
    turned = [(i, 1 - q, 1 - t) if i is not None and q is not None and zlib.crc32(str(i).encode()) % 3 == 1 else (i, q, t) for i, q, t in labels]
    a, b = (toxicity.judged(d, spark.createDataFrame(x, LABELS)).orderBy("doc_id", "score").collect() for x in (labels, turned))
    assert a == b


def test_offending_sentence_is_located(spark):
    docs, labels = made()
    d, l = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    model = toxicity.trained(d, l, "toxic", F.lit(True))
    text = "Ba lo mi. Ken é grumblex tar vilesnort! Sol wi"
    (row,) = toxicity.scored(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert [text.encode()[s.start : s.end].decode() for s in row.offending] == [" Ken é grumblex tar vilesnort"]


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in toxicity.judged(docs, none).collect()] == [0.0, 0.0]
    assert [r.score for r in quality.judged(docs, none).collect()] == [0.5, 0.5]
    for judged in (toxicity.judged, quality.judged):
        assert judged(docs.limit(0), none).collect() == []


def test_pairs_of_features_in_linear_time():
    m = quality.Machine(3)
    rng = np.random.default_rng(1)
    m.w, m.v = rng.normal(size=m.w.shape), rng.normal(size=m.v.shape)
    rows, cols, vals = np.array([0, 0, 0, 1, 1]), np.array([1, 2, 3, 2, 9]), np.array([0.5, 1.0, -2.0, 1.5, 3.0])
    z, _ = m.raw(rows, cols, vals, 2)
    for k in (0, 1):
        c, x = cols[rows == k], vals[rows == k]
        pairs = sum(m.v[c[i]] @ m.v[c[j]] * x[i] * x[j] for i in range(len(c)) for j in range(i))
        assert np.isclose(z[k], m.bias + m.w[c] @ x + pairs)


def long_text():
    r = random.Random(8)
    return "".join(r.choice(["ba", "lo", "KEN", "grumblex", " ", ". ", "  ", "\n", "é", "#"]) for _ in range(20000)).encode()


def test_long_texts_by_stretches(monkeypatch):
    from quern.llm import common

    text = long_text()
    buf, offs = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    twice, both = np.concatenate([buf, buf]), np.array([0, len(buf), 2 * len(buf)])
    known = np.unique(toxicity.features(buf, offs)[0])[::3]
    model = toxicity.Model(known, np.random.default_rng(1).normal(size=len(known)))
    q, t, p = quality.features(twice, both), model.sentences(twice, both), toxicity._present(twice, both)
    for f in (common.stretches, common.chunks):
        monkeypatch.setattr(f, "__defaults__", (900,))
    for m in (quality, toxicity):
        monkeypatch.setattr(m, "CHUNK", 900)
    r, c, x, stats = quality.features(buf, offs)
    own = q[0] == 0
    assert not r.any() and c.tolist() == q[1][own].tolist() and np.allclose(x, q[2][own]) and np.allclose(stats[0], q[3][0])
    row, at, prob = model.sentences(buf, offs)
    own = t[0] == 0
    assert not row.any() and np.allclose(prob, t[2][own])
    assert [np.count_nonzero(toxicity.STOPS[buf[:k]]) for k in at] == [np.count_nonzero(toxicity.STOPS[buf[:k]]) for k in t[1][own]]
    assert toxicity._present(buf, offs)[0].tolist() == np.unique(p[0]).tolist()


def test_toxicity_against_brute_force(spark):
    """The score from the model's weights: sentences by hand, a logistic of each, noisy-or of all."""
    docs, labels = made(200)
    docs = docs[:-1]
    d = spark.createDataFrame(docs, DOCS)
    model = toxicity.trained(d, spark.createDataFrame(labels, LABELS), "toxic", F.lit(True))
    weight = dict(zip(model.known.tolist(), model.weights.tolist(), strict=True))
    got = sorted((str(r.doc_id), round(r.score, 9)) for r in toxicity.scored(d, model).collect())
    want = []
    for i, text, *_ in docs:
        clean = 1.0
        for sentence in re.split(rb"[.!?\n\r]", (text or "").encode().lower()):
            own = set()
            for w in re.findall(rb"[0-9a-z\x80-\xff]+", sentence):
                one = lambda x: int(Fingerprints(np.frombuffer(x, np.uint8), 11).of(np.array([0]), np.array([len(x)]))[0])
                own |= {one(w)} | {(one(w[:n]) + n) % 2**64 for n in toxicity.BEGINNINGS if len(w) > n}
            z = [weight[f] for f in own if f in weight]
            clean *= 1 - 1 / (1 + np.exp(-sum(z) - model.bias)) if z else 1
        want.append((str(i), 1 - clean))
    want.sort()
    assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-6)
    kept = toxicity.kept(d, model, 0.7)
    assert kept.columns == d.columns and kept.count() == sum(w < 0.7 for _, w in want)


def test_quality_against_brute_force(spark):
    """The score with every pair of features multiplied out."""
    docs, labels = made(120)
    docs = docs[:-1]
    d = spark.createDataFrame(docs, DOCS)
    m = quality.trained(d, spark.createDataFrame(labels, LABELS), "quality", F.lit(True))
    got = {(r.doc_id, i): r.score for i, r in enumerate(quality.scored(d.repartition(1), m).collect()) if r.doc_id is not None and r.doc_id > 0}
    assert len({i for i, _ in got}) == len(got)
    for (i, _), score in list(got.items())[::7]:
        text = next(t for k, t, *_ in docs if k == i) or ""
        buf = np.frombuffer(text.encode(), np.uint8)
        _, c, x, stats = quality.features(buf, np.array([0, len(buf)]))
        c, x = [*c, *range(quality.BUCKETS, quality.BUCKETS + quality.STATS)], [*x, *np.clip((stats[0] - m.mean) / m.scale, -6, 6)]
        z = m.bias + sum(m.w[a] * b for a, b in zip(c, x, strict=True)) + sum(m.v[c[a]] @ m.v[c[b]] * x[a] * x[b] for a in range(len(c)) for b in range(a))
        assert np.isclose(score, 1 / (1 + np.exp(-z)))


def test_columns_that_clash(spark):
    d = spark.createDataFrame([(1, "a", 1, 2.0), (1, None, 2, 3.0), (None, "", 3, 4.0)], "doc_id long, text string, y int, score double")
    assert toxicity.kept(d, toxicity.Model(np.zeros(0, np.uint64)), 0.7).orderBy("y").collect() == d.orderBy("y").collect()
    assert toxicity.kept(d.limit(0), toxicity.Model(np.zeros(0, np.uint64)), 0.7).collect() == []
