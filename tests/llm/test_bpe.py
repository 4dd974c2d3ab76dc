import hashlib
import random

import pytest
from quern.llm import bpe
from quern.llm.token_counts import token_counts

tokenizers = pytest.importorskip("tokenizers")
PATH = bpe.vocabulary()


def texts():
    r = random.Random(3)
    out = ["".join(r.choice("etaoinshrdlu" + " " * 2) for _ in range(50)) for _ in range(400)]
    pick = lambda: chr(r.choice([r.randint(32, 126), r.randint(160, 700), r.randint(0x4E00, 0x5000), r.randint(0x1F600, 0x1F640), 9, 10, 13, 32]))
    out += ["".join(pick() for _ in range(60)) for _ in range(400)]
    out += ["a" * n for n in range(1, 80)] + ["ab" * n for n in range(40)]
    return [*out, "<|endoftext|>x<|endoftext|><|endoftext|> y", " ", "", "  a   b \n\n c", " 　 x", "it's we'll 'S", "z " * 30000, "q" * 3000]


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_encoding_equals_the_library(piece, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", piece)
    own, lib, t = bpe.Bpe(PATH), tokenizers.Tokenizer.from_file(PATH), texts()
    ids, counts = own.encode(t)
    want = lib.encode_batch(t, add_special_tokens=False)
    assert ids.tolist() == [i for e in want for i in e.ids] and counts.tolist() == [len(e.ids) for e in want]
    assert [x.decode() for x in own.decode(ids, counts)] == t


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    own, lib, t = bpe.Bpe(PATH), tokenizers.Tokenizer.from_file(PATH), texts()[:300]
    ids = [x for i in range(0, 300, 20) for x in own.encode(t[i : i + 20])[0].tolist()]
    assert ids == [i for e in lib.encode_batch(t, add_special_tokens=False) for i in e.ids]


def test_compatible_pairs_and_exact_merging_agree():
    import numpy as np

    own, r = bpe.Bpe(PATH), np.random.default_rng(1)
    a, b = r.integers(0, 3000, 4000), r.integers(0, 3000, 4000)
    whole = [i for i in range(3000) if own.merged(own.bytes[i]) == [i]]
    ok = np.isin(a, whole) & np.isin(b, whole)
    a, b = a[ok], b[ok]
    assert own.compatible(a, b).tolist() == [own.merged(own.bytes[x] + own.bytes[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    some = [own.bytes[x] + own.bytes[y] * 3 for x, y in zip(a.tolist()[:500], b.tolist(), strict=False)]
    tok, whose = own.merged_all(some)
    assert [tok[whose == i].tolist() for i in range(500)] == [own.merged(t) for t in some]


def frame(spark):
    rows = [(i, t, "x", [1]) for i, t in enumerate(texts())] + [(None, None, None, None), (0, "twice", "x", [2]), (0, "twice", "x", [2])]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids array<int>")


def test_digest(spark):
    lib = tokenizers.Tokenizer.from_file(PATH)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in frame(spark).collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in bpe.digest(frame(spark), PATH).collect())
    one, two = bpe.encoded(frame(spark), PATH, decode=True), bpe.decoded(bpe.encoded(frame(spark), PATH), PATH)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    assert bpe.digest(frame(spark).limit(0), PATH).collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_libraries(spark, name):
    path = bpe.vocabulary(name)
    if name.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(sp.encode(t))
    else:
        lib = tokenizers.Tokenizer.from_file(path)
        count = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    want = [(r.doc_id, len((r.text or "").encode()), n := count(r.text or ""), n > 20) for r in frame(spark).collect()]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in token_counts(frame(spark), path, limit=20).collect())
    assert token_counts(frame(spark).limit(0), path).collect() == []


def test_merges_that_give_one_token_are_refused(tmp_path):
    import json

    letters = sorted(bpe.byte_letters(), key=bpe.byte_letters().get)
    vocab = {c: i for i, c in enumerate(letters)} | {"ab": 256, "bc": 257, "abc": 258}
    spec = {"model": {"type": "BPE", "vocab": vocab, "merges": ["a b", "b c", "ab c", "a bc"]}, "pre_tokenizer": {"type": "ByteLevel"}, "added_tokens": []}
    (tmp_path / "two.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="two merges"):
        bpe.Bpe(str(tmp_path / "two.json"))


def test_frequent_words_come_from_all_texts(spark, monkeypatch):
    from quern.llm import token_counts as tc

    rows = [(i, "first words only " * 3) for i in range(50)] + [(i, "it's  later: often 12 often\n\noften" + " x" * i) for i in range(50, 2500)]
    words = tc.frequent_words(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), PATH)
    lib = tokenizers.Tokenizer.from_file(PATH)
    assert {" often", " later", ":", " 12", " x", "often"} <= set(words)
    assert all(n == len(lib.encode(w, add_special_tokens=False).ids) for w, n in words.items())
    monkeypatch.setattr(tc, "LOOKED_UP", 10)
    monkeypatch.setattr(tc, "CACHE", 20)
    monkeypatch.setattr(bpe, "PIECE", 30)
    counts = tc.Counts(PATH, words)
    t = texts()
    assert counts.of(t) == [len(e.ids) for e in lib.encode_batch(t, add_special_tokens=False)]
    assert not any(len(w) > tc.CACHED_LENGTH for w in counts.cached) and len(counts.cached) <= 20 + len(words) + 1000


def test_table_stays_bounded(monkeypatch):
    import numpy as np
    from quern.llm import token_counts as tc

    monkeypatch.setattr(tc, "COUNTED", 100)
    table = tc._Table()
    for i in range(60):
        text = (" often seen " + " ".join(f"w{i}x{k}" for k in range(40))).encode()
        table.add(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert len(table.counts) <= 100 and table.counts[b" often"] == 60 == table.counts[b" seen"]
    table.add(np.zeros(0, np.uint8), np.array([0]))
