import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.operators import segments as G


@pytest.mark.parametrize(
    ("text", "passes", "want"),
    [
        ("待って…！", 1, "待って...!"), ("ええ~~~", 1, "ええ…"), ("ええ~~~", 2, "ええ..."), ("{漢字/かんじ}を{読/よ}む", 1, "漢字を読む"), ("x{a{b/c}:d}y", 1, "xaby"), ("a{note}b", 1, "ab"),
        ("soooooo good", 1, "soo good"), ("哈哈哈哈哈", 1, "哈哈"), ("aaa", 1, "aaa"), ("Wow!!!!!", 1, "Wow!!"), ("keep\n%%%###\nthis", 1, "keep\nthis"), ("keep\na***", 1, "keep"), ("ab***", 1, "ab***"),
        ("**", 1, "**"), ("--", 1, "--"), ("a\na\n\na\nb\nb", 1, "a\n\na\nb"), ("I\nI go\nI go home", 1, "I go home"), ("I go home\nI go\nI", 1, "I go home"), ("I\nI go", 1, "I\nI go"),
        ("a! b! b! c!", 1, "a! b! c!"), ("&lt;b&gt;x", 1, "<b>x"), ("&lt;b&gt;x", 2, "x"), ("a\tb\x0cc\x00d", 1, "a bcd"), ("<p>Hi</p>", 1, "Hi"), ("♥x※y", 1, "x y"), ("Ａ１", 1, "A1"), ("", 1, ""), (None, 1, ""),
        ("***###\n\nword here now", 1, "word here now"), ("a\r\n\r\n\r\nb", 1, "a\n\nb"), ("----", 1, "——"),
    ],
)
def test_clean(one, text, passes, want):
    assert one(lambda c: X.clean(c, passes), text) == want


STEPS = [X.symbols, X.clean_lines, X.collapse_lines, X.widest_of_progression, X.sentences_once, X.single_gaps]


def test_native_steps_and_fused_function_agree(spark):
    """The steps, each in a projection of its own, equal the one function."""
    texts = ["a! b! b!  b! c", "x\n\n\n\ny\ny\n  y  \n\n%%%###\nz", "aaaa哈哈哈哈 !!!! ???? ~~~ 。。。", "a\nab\nabc", "abc\nab\na\n", "（ x ） 「 y 」", "", "  \n ", "!!!\n!!!", "one.\n***\none.", "…\n…", "é\u3000è\u2028ü", "\n\n***###\nq"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.unescaped(X.without_tags(X.without_braces(X.single_tabs(X.without_controls(X.line_feeds(X.nfkc("t"))))))).alias("s"), X.clean(F.col("t")).alias("want"))
    for step in STEPS:
        df = df.withColumn("s", step(F.col("s"))).cache()
    for r in df.collect():
        assert r.s == r.want, repr(texts[r.i])


def lengths(one, text):
    return [len(p) for p in one(G.pieces, text)]


def test_pieces(one):
    assert lengths(one, "x" * 500) == [220, 220, 60]
    assert lengths(one, "a" * 149 + "!" + "b" * 59 + "!" + "c" * 29 + "!") == [210, 30]
    assert lengths(one, "a" * 299 + "!" + "b" * 9 + "!") == [300, 10]
    assert lengths(one, "  ") == [] and lengths(one, "short") == [5]
    assert G._packed(["ab", "cd", "e"], 220) == ["abcde"] and one(G.packed_sentences, "ab! cd! " + "e" * 220) == ["ab!cd!", "e" * 220]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text("ab !?。)\n", max_size=400), min_size=1, max_size=6))
def test_pieces_hold_what_the_block_holds(texts):
    from pyspark.sql import SparkSession

    df = SparkSession.getActiveSession().createDataFrame([(t,) for t in texts], "t string")
    for t, ps in df.select("t", G.pieces(F.col("t"))).collect():
        squeezed = "".join(t.split())
        assert "".join("".join(p.split()) for p in ps) == squeezed
        assert all(p and p == p.strip() for p in ps)


def test_web_segments(spark):
    html = '<script>var t="</p>";</script><p>Hi &amp; bye</p><p>Hi &amp; bye</p>'
    rows = G.web_segments(spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<b>one</b>")], "page_id int, html string"), "page_id", "html").collect()
    assert [tuple(r) for r in rows] == [(1, 1, "Hi & bye"), (1, 2, "Hi & bye"), (4, 1, "one")]


def test_transcript_ids_and_record(spark):
    s = [(7, 0.0, 1.0, "a"), (None, None, None, ""), (None, 2.0, None, "b")]
    df = spark.createDataFrame([("d", s)], "doc string, segments array<struct<id:bigint,start:double,end:double,text:string>>")
    rows = G.transcript_segments(df, "doc", "segments")
    assert [(r.id, r.text) for r in rows.collect()] == [(7, "a"), (2, "b")]
    record = G.document_record(rows, "doc", "transcript").first()
    assert record.has_timestamps and record.language == "auto" and [x.id for x in record.segments] == [2, 7]
