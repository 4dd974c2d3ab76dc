import hashlib

from quern.llm import chat


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_round_trip_of_control_strings():
    texts = ["", "<|im_end|>", "<", "|>", "\\", "\\<|\\|", "a\n<|im_start|>user\nx<|im_end|>\n", "<<|", "<\\|im_end|>", "é😀" * 9, "x" * 100_000]
    turns = [("assistant" if i % 2 else "user", t) for i, t in enumerate(texts)] + [("odd\nrole<|\\n", "y"), ("", "z")]
    text, spans = chat.rendered(turns)
    assert chat.parsed(text) == turns
    assert [chat.unescaped(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_fold():
    log = [
        (0, "message", "user", "hi"), (1, "delta", "assistant", "he"), (1, "delta", "assistant", "llo"), (2, "message", "user", "more"), (3, "message", "assistant", "old"),
        (3, "regenerate", "", ""), (3, "delta", "", "new"), (4, "message", "user", "bye"), (2, "edit", "", "less"), (3, "delta", "assistant", "ok"), (5, "message", "x", "y"), (5, "delete", "", ""),
    ]
    assert chat.folded(iter(log)) == [("user", "hi"), ("assistant", "hello"), ("user", "less"), ("assistant", "ok")]
    assert chat.folded(iter([(None, "message", "a", "1"), (None, "delta", "a", "2"), (None, "message", "b", "3")])) == [("a", "12"), ("b", "3")]


def test_table(spark):
    rows = [
        (1, 1, "assistant", "b<|im_end|>"), (1, 0, "user", "a"), (1, 2, "user", None), (2, 0, None, None), (None, None, "assistant", "n"), (None, 0, "user", "é"),
        (3, 0, "user", "t"), (3, 0, "user", "t"), (3, 0, "assistant", "s"), *[(4, i, "assistant" if i % 2 else "user", f"{i}") for i in range(300)],
    ]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn long, role string, text string, kind string, seq int")
    got = {r.conv_id: r for r in chat.digest(chat.formatted(chat.logged(df))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        loss = "".join(t for _, role, t in own if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{role}\n{t}\n" for _, role, t in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.formatted_chars == sum(24 + len(role) + len(chat.escaped(t)) for _, role, t in own)
    assert chat.digest(chat.formatted(chat.logged(df.limit(0)))).collect() == []
