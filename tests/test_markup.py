"""Element trees: rules for open elements, extents, selectors, and random trees against what they were written from."""

import random

import pytest
from pyspark.sql import functions as F

from quern.functions import markup
from quern.operators import rules


def tree(source):
    """name, parent's name, the HTML within."""
    page = markup.parsed(source)
    return [(e.name, page.elements[e.parent].name if e.parent >= 0 else None, source[e.inside : e.until]) for e in page.elements]


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<div>a<br>b<img src=x>c</div>d", [("div", None, "a<br>b<img src=x>c"), ("br", "div", ""), ("img", "div", "")]),
        ("<p>a<p>b<div>c</div>d", [("p", None, "a"), ("p", None, "b"), ("div", None, "c")]),
        ("<p><b>a<br><p>b</p>", [("p", None, "<b>a<br>"), ("b", "p", "a<br>"), ("br", "b", ""), ("p", None, "b")]),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", [("ul", None, "<li>a<ul><li>b</ul><li>c"), ("li", "ul", "a<ul><li>b</ul>"), ("ul", "li", "<li>b"), ("li", "ul", "b"), ("li", "ul", "c")]),
        ("<table><tr><td>a<td>b<tr><td><p>c</table>d", [("table", None, "<tr><td>a<td>b<tr><td><p>c"), ("tr", "table", "<td>a<td>b"), ("td", "tr", "a"), ("td", "tr", "b"), ("tr", "table", "<td><p>c"), ("td", "tr", "<p>c"), ("p", "td", "c")]),
        ("<dl><dt>a<dd>b<dt>c</dl>", [("dl", None, "<dt>a<dd>b<dt>c"), ("dt", "dl", "a"), ("dd", "dl", "b"), ("dt", "dl", "c")]),
        ("<script>if (a<b) '</p><div>'</script ><p>x", [("script", None, "if (a<b) '</p><div>'"), ("p", None, "x")]),
        ("<title>a <b> c</title>", [("title", None, "a <b> c")]),
        ("<!-- <p> --><a title='x>y'>z</a></b>", [("a", None, "z")]),
        ("<b>a<p>b</b>c</p>d", [("b", None, "a<p>b"), ("p", "b", "b</b>c")]),
        ("<div><span>a</div>b</span>c", [("div", None, "<span>a"), ("span", "div", "a")]),
        ("<div><table><tr><td></div>a</td></tr></table>b</div>", [("div", None, "<table><tr><td></div>a</td></tr></table>b"), ("table", "div", "<tr><td></div>a</td></tr>"), ("tr", "table", "<td></div>a</td>"), ("td", "tr", "</div>a")]),
        ("<svg><path/><g/></svg><DIV CLASS=A>b", [("svg", None, "<path/><g/>"), ("path", "svg", ""), ("g", "svg", ""), ("div", None, "b")]),
        ("a < b <3 <> </> <", []), ("", []), ("<p", []), ("<!-- never closed <p>", []), ("<select><option>a<option>b</select>", [("select", None, "<option>a<option>b"), ("option", "select", "a"), ("option", "select", "b")]),
    ],
)
def test_trees(source, want):
    assert tree(source) == want


def test_random_trees_come_back():
    """Well-formed trees: names, parents and extents are what was written."""
    rng = random.Random(1)
    for _ in range(100):
        want, out = [], []

        def write(parent, depth):
            for _ in range(rng.randrange(4)):
                if rng.random() < 0.4:
                    out.append(rng.choice(["text ", "a &lt; b ", "<!-- <i> -->", "日本 "]))
                    continue
                name = rng.choice(["div", "section", "span", "em", "br"] if depth < 5 else ["br"])
                number = len(want)
                begin = sum(map(len, out))
                out.append(f"<{name} class='c{number % 3} x' data-n=\"{number}>\">")
                e = [name, parent, begin, sum(map(len, out)), None, None]
                want.append(e)
                if name != "br":
                    write(number, depth + 1)
                    e[4] = sum(map(len, out))
                    out.append(f"</{name}>")
                else:
                    e[4] = e[3]
                e[5] = sum(map(len, out))

        write(-1, 0)
        source = "".join(out)
        got = markup.parsed(source).elements
        assert [[e.name, e.parent, e.begin, e.inside, e.until, e.end] for e in got] == want
        assert [e.attributes["data-n"] for e in got] == [f"{i}>" for i in range(len(want))]


def test_selectors():
    source = '<main id=m><ul class="a b"><li><a href="/x" rel="me next">1</a><li class=b><p><a href="http://y">2</a></ul></main><a>3</a>'
    page = markup.parsed(source)
    found = lambda s: [page.text(e) for e in markup.select(page, s)]
    assert found("a") == ["1", "2", "3"] and found("main a") == ["1", "2"] and found("li > a") == ["1"] and found("ul.a.b > li.b a[href]") == ["2"]
    assert found("#m > ul li p > a, main > ul > a") == ["2"]
    assert found('[href^="http"]') == ["2"] and found("a[rel~=next]") == ["1"] and found("a[href$=x], a[href*='//']") == ["1", "2"] and found("* > p") == ["2"]
    for broken in ("", "a >", "> a", "a:hover", "a,,b", ".", "a[", "a[x=']"):
        with pytest.raises(ValueError, match="selector"):
            markup.selector(broken)


def test_long_and_hostile_pages_take_linear_time():
    import time

    for source in ("<a " * 200_000, "<" * 200_000, "<p>" * 100_000, "<!--" * 100_000, '<a x="' * 100_000, "</b>" * 100_000):
        began = time.time()
        markup.parsed(source)
        assert time.time() - began < 20


def test_fields_stay_within_their_element(spark):
    rows = [
        ('<div class=product><span class=name>A</span><b class="price x">1</b></div><div class=product><span class=name>B</span></div><p class=price>77</p>', [("A", "1"), ("B", None)]),
        ('<div class="product big"><h2 class=name><b>A</b> &amp; <i>co</i></h2><div class=product><p class=name>inner<p class=price>2</div></div>', [("A & co", "2"), ("inner", "2")]),
        ("<div class=products><p class=name>no</div>", []), ("", []), (None, None), ("<div class=product><p class=name> </p></div>", [(None, None)]),
    ]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(rows)], "i int, h string")
    got = df.select("i", rules.extracted_fields(F.col("h"), "product", ["name", "price"]).alias("x")).orderBy("i").collect()
    assert [None if r.x is None else [tuple(f) for f in r.x] for r in got] == [w for _, w in rows]


def test_columns(spark):
    df = spark.createDataFrame([("<ul id=u><li class='a b'>x</ul>",), (None,), ("plain",)], "h string")
    got = [r.e for r in df.select(markup.elements(F.col("h")).alias("e")).collect()]
    assert [(e.number, e.parent, e.depth, e.name, e.id, e.classes, e.begin, e.end) for e in got[0]] == [(0, -1, 0, "ul", "u", [], 0, 31), (1, 0, 1, "li", None, ["a", "b"], 9, 26)]
    assert got[1:] == [None, []]
    assert [[(s.name, s.text, s.inner) for s in r.e] for r in df.where("h LIKE '<%'").select(markup.selected(F.col("h"), "li.a").alias("e")).collect()] == [[("li", "x", "x")]]
