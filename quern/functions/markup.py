"""Elements of HTML: a tokeniser and a stack of open elements, with selectors.

The tree is a simple form of what browsers build. Elements without content never open; some start tags end elements that are still open, as a paragraph
ends where a block begins; scripts, styles, titles and text fields hold text alone; an end tag ends what is open within its element, and one without such
an element is passed over. The end tag of a formatting element, met inside a block that it holds, ends the formatting alone: the block stays open, and
the two overlap. Formatting isn't opened again behind a block, missing html, head and body elements aren't added, and nothing is moved out of tables.
"""

from __future__ import annotations

import bisect
import functools
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

#: Elements by what they are; fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style iframe noembed noframes".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
CELLS = frozenset("table caption td th template button object html".split())
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
LISTS = CELLS | frozenset("ul ol menu dl select article aside blockquote section main nav form fieldset body".split())
#: Start tags: which open elements they end, and which ones hide these from them; fixed values.
ENDS = {
    **{b: (frozenset(["p"]), CELLS) for b in BLOCKS}, "li": (frozenset(["li"]), LISTS - {"form"}), "dt": (frozenset(["dt", "dd"]), LISTS), "dd": (frozenset(["dt", "dd"]), LISTS),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup", "datalist"])), "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "tr": (frozenset(["tr"]), frozenset(["table", "template"])), "td": (frozenset(["td", "th"]), frozenset(["tr", "table", "template"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table", "template"])),
    **{b: (frozenset(["tr", "tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table", "template"])) for b in ("tbody", "thead", "tfoot")},
    "rt": (frozenset(["rt", "rp"]), frozenset(["ruby"])), "rp": (frozenset(["rt", "rp"]), frozenset(["ruby"])), "body": (frozenset(["head"]), frozenset()),
}

_TOKEN = re.compile(
    r"""<!--(?:>|->|(?s:.*?)(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+|=)*+)>|<[!?/][^>]*+>"""
)
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")


@dataclass(slots=True)
class Element:
    """An element: its place in the document's order, its parent's (-1: none), and where it begins, its content begins and ends, and it ends."""

    number: int
    parent: int
    depth: int
    name: str
    attributes: dict[str, str]
    begin: int
    inside: int
    until: int = -1
    end: int = -1

    @property
    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()


@dataclass(slots=True)
class Page:
    source: str
    elements: list[Element] = field(default_factory=list)
    texts: list[tuple[int, int]] = field(default_factory=list)  # of what is seen, in order

    def text(self, e: Element) -> str:
        """What is seen of an element's text, with entities decoded."""
        i, out = bisect.bisect_left(self.texts, (e.inside,)), []
        if i and self.texts[i - 1][1] > e.inside:
            i -= 1
        while i < len(self.texts) and self.texts[i][0] < e.until:
            out.append(self.source[max(e.inside, self.texts[i][0]) : min(e.until, self.texts[i][1])])
            i += 1
        return entities.unescape("".join(out))


def _attributes(said: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(said):
        out.setdefault(m[1].lower(), entities.unescape(next((x for x in m.groups()[1:] if x is not None), "")))
    return out


def parsed(source: str) -> Page:
    """The elements and texts of a page, in the order in which they begin."""
    page, open_ = Page(source), []

    def close(i: int, until: int, end: int) -> None:
        """Ends the open elements from place i on; only the first of them has an end tag."""
        for k, e in enumerate(open_[i:]):
            e.until, e.end = until, end if k == 0 else until
        del open_[i:]

    def begun(name: str, at: int) -> None:
        ends, hidden = ENDS.get(name, ((), ()))
        cut = None
        for i in range(len(open_) - 1, -1, -1) if ends else ():
            if open_[i].name in hidden:
                break
            if open_[i].name in ends:
                cut = i
        if cut is not None:
            close(cut, at, at)

    def ended(name: str, at: int, end: int) -> None:
        for i in range(len(open_) - 1, -1, -1):
            e = open_[i]
            if e.name == name:
                if name in FORMATTING and any(x.name in BLOCKS for x in open_[i + 1 :]):
                    e.until, e.end = at, end
                    del open_[i]
                else:
                    close(i, at, end)
                return
            if e.name in CELLS and name not in CELLS and name not in ("tr", "tbody", "thead", "tfoot", "body"):
                return

    at, last = 0, max(source.rfind(">"), source.rfind("<!--") + 1)
    while at < len(source):
        m = _TOKEN.search(source, at) if at < last else None
        if m is None:
            break
        if m.start() > at:
            page.texts.append((at, m.start()))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            ended(name, m.start(), at)
            continue
        begun(name, m.start())
        e = Element(len(page.elements), open_[-1].number if open_ else -1, open_[-1].depth + 1 if open_ else 0, name, _attributes(m[3]), m.start(), at)
        page.elements.append(e)
        if name in VOID or (m[3].endswith("/") and any(x.name in ("svg", "math") for x in open_)):
            e.until = e.end = at
        elif name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
            e.until, e.end = stop.span() if stop else (len(source), len(source))
            if name not in UNSEEN and e.until > at:
                page.texts.append((at, e.until))
            at = e.end
        else:
            open_.append(e)
    if at < len(source):
        page.texts.append((at, len(source)))
    close(0, len(source), len(source))
    return page


# Selectors

_SIMPLE = re.compile(r"""([*a-zA-Z][\w-]*|\*)|\.([\w-]+)|\#([\w-]+)|\[\s*([\w-]+)\s*(?:([~^$*]?)=\s*(?:"([^"]*)"|'([^']*)'|([^\]\s"']*))\s*)?\]""")


@functools.lru_cache(maxsize=256)
def selector(said: str) -> list[list[tuple[str, list[tuple]]]]:
    """A selector list: names, .classes, #ids, [attributes] (there, =, ~=, ^=, $=, *=), descendants by blanks, children by ">", alternatives by ",".

    Each alternative is a list of steps from the last one on: how it is tied to the one behind it, and its conditions."""
    out = []
    for alternative in re.split(r",(?![^\[]*\])", said):
        steps, tie, at, text = [], " ", 0, alternative.strip()
        if not text:
            raise ValueError(f"empty selector in: {said}")
        conditions: list[tuple] = []
        while at < len(text):
            if m := re.compile(r"\s*>\s*|\s+").match(text, at):
                if not conditions:
                    raise ValueError(f"not a selector: {said}")
                steps.append((tie, conditions))
                tie, conditions = m[0].strip() or " ", []
            elif m := _SIMPLE.match(text, at):
                conditions.append(("name", m[1].lower()) if m[1] else ("class", m[2]) if m[2] else ("id", m[3]) if m[3] else ("attribute", m[4].lower(), m[5], next((x for x in (m[6], m[7], m[8]) if x is not None), None)))
            else:
                raise ValueError(f"not a selector: {said}")
            at = m.end()
        if not conditions:
            raise ValueError(f"not a selector: {said}")
        out.append([*steps, (tie, conditions)])
    return out


def _fits(e: Element, conditions: list[tuple]) -> bool:
    for kind, *what in conditions:
        if kind == "name":
            ok = what[0] in ("*", e.name)
        elif kind == "class":
            ok = what[0] in e.classes
        elif kind == "id":
            ok = e.attributes.get("id") == what[0]
        else:
            name, how, value = what
            has = e.attributes.get(name)
            ok = has is not None and (
                value is None or (has == value if not how else bool(value) and (value in has.split() if how == "~" else has.startswith(value) if how == "^" else has.endswith(value) if how == "$" else value in has))
            )
        if not ok:
            return False
    return True


def _matches(page: Page, e: Element, steps: list) -> bool:
    def up(e: Element, i: int) -> bool:
        if not _fits(e, steps[i][1]):
            return False
        if i == 0:
            return True
        parent = e.parent
        while parent >= 0:
            if up(page.elements[parent], i - 1):
                return True
            if steps[i][0] == ">":
                return False
            parent = page.elements[parent].parent
        return False

    return up(e, len(steps) - 1)


def select(page: Page, said: str, within: Element | None = None) -> list[Element]:
    """The page's elements, or those within one of them, that a selector fits, in order."""
    wanted = selector(said)
    among = page.elements
    if within is not None:  # an element's descendants follow it without a gap
        last = within.number + 1
        while last < len(among) and among[last].depth > within.depth:
            last += 1
        among = among[within.number + 1 : last]
    return [e for e in among if any(_matches(page, e, steps) for steps in wanted)]


# As columns

ELEMENT = "struct<number:int,parent:int,depth:int,name:string,id:string,classes:array<string>,attributes:map<string,string>,begin:int,inside:int,until:int,end:int>"
SELECTED = "struct<number:int,name:string,attributes:map<string,string>,text:string,inner:string>"


def _rows(df: DataFrame, key: str, source: str, of, fields: dict[str, pa.DataType]) -> DataFrame:
    """key and fields: a row for each tuple that of (a page's source) gives, handed on when a million characters are read, so that a task's memory doesn't
    grow with the pages of a batch."""
    rows = df.select(key, F.col(source).cast("string").alias("_source"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, got, size = [], [], 0
            for i, t in enumerate(batch.column(1)):
                t = t.as_py()
                found = [] if t is None else of(t)
                at += [i] * len(found)
                got += found
                size += len(t or "")
                if size > 1 << 20 or i + 1 == len(batch):
                    columns = zip(*got, strict=True) if got else [()] * len(fields)
                    yield pa.record_batch([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, fields.values(), strict=True))], [batch.schema.names[0], *fields])
                    at, got, size = [], [], 0

    return rows.mapInArrow(run, T.StructType([rows.schema[key], *(T.StructField(n, from_arrow_type(k)) for n, k in fields.items())]))


def element_rows(df: DataFrame, key: str, source: str) -> DataFrame:
    """key, number, parent, depth, name, begin, inside, until, end: elements() as rows, without their attributes."""
    names = ["number", "parent", "depth", "name", "begin", "inside", "until", "end"]
    return _rows(df, key, source, lambda t: [tuple(getattr(e, n) for n in names) for e in parsed(t).elements], {n: pa.string() if n == "name" else pa.int32() for n in names})


def selected_rows(df: DataFrame, key: str, source: str, said: str) -> DataFrame:
    """key, pos (from 0 on), name, text, inner: selected() as rows, without attributes."""
    selector(said)

    def of(t: str) -> list[tuple]:
        page = parsed(t)
        return [(i, e.name, page.text(e), t[e.inside : e.until]) for i, e in enumerate(select(page, said))]

    return _rows(df, key, source, of, {"pos": pa.int32(), "name": pa.string(), "text": pa.string(), "inner": pa.string()})


def elements(source: Column) -> Column:
    """array of a page's elements, in order, with their extents in characters. Null gives null, a text without tags none."""

    @F.pandas_udf(f"array<{ELEMENT}>")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: None if t is None else [(e.number, e.parent, e.depth, e.name, e.attributes.get("id"), e.classes, e.attributes, e.begin, e.inside, e.until, e.end) for e in parsed(t).elements])

    return run(source)


def selected(source: Column, said: str) -> Column:
    """array of the elements that a selector fits: number, name, attributes, the text that is seen, and the HTML within."""
    selector(said)  # a broken one fails here, not in a task

    @F.pandas_udf(f"array<{SELECTED}>")
    def run(x: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            page = parsed(t)
            return [(e.number, e.name, e.attributes, page.text(e), t[e.inside : e.until]) for e in select(page, said)]

        return x.map(one)

    return run(source)


def fields_of(source: Column, item: str, fields: dict[str, str]) -> Column:
    """array<struct> of the elements that the selector item fits, each with the text of the first element within it that a field's selector fits,
    stripped; null where there is none, or where it has no text."""
    for s in (item, *fields.values()):
        selector(s)
    kind = T.StructType([T.StructField(f, T.StringType()) for f in fields])

    @F.pandas_udf(T.ArrayType(kind))
    def run(x: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            page = parsed(t)
            first = lambda e, s: next((page.text(f).strip() or None for f in select(page, s, e)), None)
            return [tuple(first(e, s) for s in fields.values()) for e in select(page, item)]

        return x.map(one)

    return run(source)
