import random
import re
from itertools import combinations

import numpy as np
import pytest
from quern.llm import ngram_join as nj
from quern.llm.components import components


def grams(text, n=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset([tuple(w)] if 0 < len(w) < n else (tuple(w[i : i + n]) for i in range(len(w) - n + 1)))


def closure(ids, edges):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def made(seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 5)))
    common = " ".join(word() for _ in range(12))
    texts = []
    for _ in range(60):
        base = [word() for _ in range(r.randint(1, 80))]
        if r.random() < 0.5:
            base += common.split()
        for _ in range(r.choice([1, 1, 2, 4])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                w[r.randrange(len(w))] = word()
            texts.append(r.choice([" ", "\n", " \t"]).join(w))
    base = [word() for _ in range(150)]
    for _ in range(90):  # one large group of near copies, some of them linked only through others
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(150)] = word()
        texts.append(" ".join(w))
    few = [None, "", "  \n", "a b", "A  b", "a b c d e", "a b c d", "É a b c d", "é a b c d", common, common.upper(), "x " * 20000 + "y", "x " * 9000 + "y"]
    return [*texts, *few, texts[0], texts[0]]


@pytest.mark.parametrize(("block", "rounds"), [(512, 2), (16, 0), (8, 1)])
def test_against_brute_force(spark, monkeypatch, block, rounds):
    monkeypatch.setattr(nj, "BLOCK", block)
    texts = made(block)
    df = spark.createDataFrame([(i * 3, t, "k", 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, node string, n int, kid int").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.linked_components(df, rounds=rounds).collect()}
    sets = {i * 3: grams(t) for i, t in enumerate(texts)}
    edges = [(a, b) for (a, x), (b, y) in combinations(sets.items(), 2) if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    root = closure(sets, edges)
    assert got == {i: (len(s), root[i]) for i, s in sets.items()}


@pytest.mark.parametrize("n", [120, 700])
def test_bound_never_drops_a_link(n):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, (20, n), dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(n) < 0.06, rng.integers(0, 1 << 60, n, dtype=np.uint64), b)[: rng.integers(n * 3 // 4, n)]) for b in base for _ in range(9)]
    size = np.array([len(s) for s in sets])
    vec = [np.minimum(np.bincount((s % np.uint64(g)).astype(int), minlength=g), nj.FULL).astype(np.uint8) for s, g in zip(sets, nj.groups_of(size).tolist(), strict=True)]
    vec = [(v[::2] | v[1::2] << 4).tobytes() for v in vec]
    tree = nj.RTree(nj.Points(vec, size))
    found = {tuple(sorted(p)) for i, j in nj.near_pairs(tree, tree, 80) for p in zip(i.tolist(), j.tolist(), strict=True)}
    linked = {(a, b) for a, b in combinations(range(len(sets)), 2) if 100 * len(x := np.intersect1d(sets[a], sets[b])) >= 80 * (size[a] + size[b] - len(x))}
    assert linked and linked <= found and len(found) < 180 * 180 / 4


def test_null_and_repeated_ids_and_empty_table(spark):
    schema = "doc_id long, text string"
    rows = nj.linked_components(spark.createDataFrame([(None, "a b c"), (7, "a b c"), (7, "a b c"), (None, "q"), (None, None), (8, None)], schema)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows) == [("7", 1, "7"), ("7", 1, "7"), ("8", 0, "8"), ("None", 0, "None"), ("None", 1, "7"), ("None", 1, "None")]
    assert nj.linked_components(spark.createDataFrame([], schema)).collect() == []


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 700)] + [(1000, 1000)]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = closure({x for e in edges for x in e}, edges)
    assert {k: got.get(k, k) for k in want} == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_one_of_each(spark):
    a, z = "one two three four five six", "another text which is linked with nothing"
    rows = [(1, a, 0, "p"), (2, a, 1, "q"), (3, z, 2, "r"), (3, a, 3, "s"), (None, a, 4, "t"), (4, None, 5, "u"), (5, "", 6, "v"), (1, a.upper(), 7, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone int, own_kid string")
    left = nj.one_of_each(df)
    assert left.columns == df.columns and sorted(r.gone for r in left.collect()) == [0, 2, 4, 5, 6, 7]
    assert nj.one_of_each(df.limit(0)).collect() == []


def test_long_texts_by_stretches(monkeypatch):
    from quern.llm import common

    r = random.Random(9)
    text = "".join(r.choice("abcdeé \n\t") for _ in range(9000)).encode()
    buf, offs = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    whole = nj.shingles(np.concatenate([buf, buf]), np.array([0, len(buf), 2 * len(buf)]), 5)
    for f in (common.stretches, common.chunks):
        monkeypatch.setattr(f, "__defaults__", (700,))
    row, got = nj.shingles(buf, offs, 5)
    assert not row.any() and got.tolist() == whole[1][whole[0] == 0].tolist()
