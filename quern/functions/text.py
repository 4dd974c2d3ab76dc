"""Text cleaning as column expressions.

Each step is a function from column to column, so Catalyst sees one projection. Only what Spark has no built-in for (compatibility
normalisation, entities, nested brace markup) is a vectorised Python function; prepared() fuses these into one call for a pass.

Java's character classes differ from those of the cleaned texts' usual tools: white space is taken as Unicode has it, by (?U).
"""

from __future__ import annotations

import html
import html.entities
import itertools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: White space, line ends, and marks that end a sentence or a quotation; fixed values.
WS = r"(?U)\s"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
ENDINGS, CLOSINGS = "。！？!?…", "」』）)"

#: Pattern and replacement of the symbol rules, in the order in which they apply; fixed values.
SYMBOL_RULES = [
    (r"[♥❤♡🖤💗💓💞💕💘]+", ""),
    (r"[※★☆◆◇□■△▽▼◎◯○●◉・･]+", " "),
    (r"[~～]{2,}", "…"),
    (r"[—–-]{3,}", "——"),
    (r"[!！]{3,}", "!!"),
    (r"[?？]{3,}", "??"),
    (r"[…。]{2,}", "…"),
    (r"([ぁ-んァ-ヶー])\1{3,}", "$1$1"),
    (r"([a-zA-Z])\1{3,}", "$1$1"),
    (r"([\u4e00-\u9fff])\1{3,}", "$1$1"),
    (r"(?U)(?<=[\u3040-\u30ff\u4e00-\u9fff])\s+(?=[、。！？…」』）])", ""),
    (r"(?U)(?<=[（「『])\s+", ""),
    (r"(?U)\s+(?=[」』）])", ""),
    (r"\n{3,}", "\n\n"),
]
#: What the symbol rules are about, in their order.
RULE_NAMES = [
    "hearts", "decor", "tildes", "dashes", "exclamations", "questions", "ellipses", "kana_runs", "latin_runs", "han_runs", "blank_before_mark", "blank_after_opening", "blank_before_closing", "blank_lines",
]
#: Besides letters and digits, these characters don't count as symbols; a fixed value.
NO_SYMBOLS = " \\-。，、！？…：；（）()「」『』【】〈〉《》“”\"'"


def strip(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)^\s+|\s+\z", "")


def lines_of(x: Column) -> Column:
    return F.split(x, LINE_END, -1)


@F.pandas_udf(StringType())
def nfkc(x: pd.Series) -> pd.Series:
    return x.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


_REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|([a-zA-Z][a-zA-Z0-9]*));")


def decoded(t: str, bare: bool = True) -> str:
    """Entities decoded; bare: as HTML has it, also those whose semicolon is missing."""
    if "&" not in t:
        return t
    return html.unescape(t) if bare else _REFERENCE.sub(lambda m: m[0] if m[1] and f"{m[1]};" not in html.entities.html5 else html.unescape(m[0]), t)


def unescaped(x: Column | str, bare: bool = True) -> Column:
    @F.pandas_udf(StringType())
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: t if t is None else decoded(t, bare))

    return run(x)


_READING, _BRACES, _TAG = re.compile(r"\{([^{}:/]+)[/:][^{}]+\}"), re.compile(r"\{[^{}]*\}"), re.compile(r"(?s)<[^>]+>")


def _without_braces(t: str) -> str:
    changed = "{" in t
    while changed:
        t, changed = _READING.subn(r"\1", t)
    return _BRACES.sub("", t)


@F.pandas_udf(StringType())
def without_braces(x: pd.Series) -> pd.Series:
    """Braces that give a reading keep what is read; others go. Inner ones come first."""
    return x.map(lambda t: t if t is None else _without_braces(t))


def line_feeds(x: Column) -> Column:
    return F.translate(F.regexp_replace(x, r"\r\n?", "\n"), "\u00a0", " ")


def without_controls(x: Column) -> Column:
    return F.regexp_replace(x, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def single_tabs(x: Column) -> Column:
    return F.regexp_replace(x, r"[\t\f\x0b]+", " ")


def without_tags(x: Column, by: str = " ") -> Column:
    return F.regexp_replace(x, r"<[^>]+>", by)


def without_scripts(x: Column) -> Column:
    for tag in ("script", "style"):
        x = F.regexp_replace(x, rf"(?is)<{tag}.*?>.*?</{tag}>", " ")
    return x


_GONE = {**dict.fromkeys([*range(9), 11, 12, *range(14, 32), 127]), 0xA0: " "}
_TABS, _GAPS = re.compile("\t+"), re.compile(r"\n\s*\n+")
_RULES = [(re.compile(p.removeprefix("(?U)")), by.replace("$1", r"\1")) for p, by in SYMBOL_RULES]
_SENTENCE = re.compile(rf"[^{ENDINGS}]*[{ENDINGS}]|[^{ENDINGS}]+")
_SYMBOL = re.compile(rf"[^\w{NO_SYMBOLS}]|_")
#: Of each symbol rule, characters of which a text must hold one for the rule to change it; None where the rule isn't about certain ones.
_TRIGGERS = [frozenset(re.sub(r"[\[\]+{}\d,]", "", p)) for p, _ in SYMBOL_RULES[:7]] + [None] * 3 + [frozenset("、。！？…」』）"), frozenset("（「『"), frozenset("」』）"), frozenset("\n")]


def _plain(t: str, bare: bool) -> str:
    """Normal form, line ends, controls, tabs, braces, tags and entities, in this order. Each is looked for first, as few texts hold any."""
    if not t.isascii() and not unicodedata.is_normalized("NFKC", t):
        t = unicodedata.normalize("NFKC", t)
    t = t.replace("\r\n", "\n").replace("\r", "\n")
    if not t.isprintable():
        t = _TABS.sub(" ", t.translate(_GONE))
    if "{" in t:
        t = _without_braces(t)
    if "<" in t:
        t = _TAG.sub(" ", t)
    return decoded(t, bare)


def _lines(t: str) -> list[str]:
    """Lines with single blanks, without those of symbols; blank lines, and lines that repeat, once."""
    lines = (" ".join(s.split()) for s in t.splitlines())
    kept = (s for s in lines if not s or len(s) > 8 or len(_SYMBOL.findall(s)) < max(3, len(s) - 1))
    once = [s for s, _ in itertools.groupby(kept)]
    return once[once[:1] == [""] : len(once) - (once[-1:] == [""])]


def _progression(lines: list[str]) -> str:
    said = [s for s in lines if s]
    for best, order in ((-1, said), (0, said[::-1])):
        if len(said) > 2 and all(map(str.__contains__, order[1:], order)):
            return said[best]
    return "\n".join(lines)


def _sentences(t: str) -> str:
    parts = _SENTENCE.findall(t)
    return "".join(next(same) for norm, run in itertools.groupby(parts, lambda p: "".join(p.split())) for same in ([run] if norm else map(iter, ([p] for p in run))))


def cleaned(t: str | None, bare: bool = True) -> str:
    """Whole cleaning of a text, once. bare: entities need no semicolon."""
    if not t:
        return ""
    t = _plain(t, bare)
    held = set(t)
    for (pattern, by), triggers in zip(_RULES, _TRIGGERS, strict=True):
        if triggers is None or not held.isdisjoint(triggers):
            t = pattern.sub(by, t)
            held |= set(by)
    t = _progression(_lines(t.strip()))
    if not held.isdisjoint(ENDINGS):
        t = _sentences(t)
    return _GAPS.sub("\n\n", t)


def symbols(x: Column) -> Column:
    for pattern, by in SYMBOL_RULES:
        x = F.regexp_replace(x, pattern, by)
    return x


def rules(x: Column, *names: str) -> Column:
    """The symbol rules of these names, in the order in which they apply."""
    for name, (pattern, by) in zip(RULE_NAMES, SYMBOL_RULES, strict=True):
        if name in names:
            x = F.regexp_replace(x, pattern, by)
    return x


def symbol_count(line: Column) -> Column:
    return F.length(F.regexp_replace(line, rf"[\p{{L}}\p{{N}}{NO_SYMBOLS}]", ""))


def is_symbol_line(line: Column) -> Column:
    n = F.length(line)
    return (line != "") & (n <= 8) & (symbol_count(line) >= F.greatest(F.lit(3), n - 1))


def clean_lines(x: Column) -> Column:
    """White space inside lines collapsed, lines of symbols dropped, blank lines kept once and not at the ends."""
    ls = F.transform(lines_of(x), lambda s: strip(F.regexp_replace(s, WS + "+", " ")))
    return strip(F.array_join(_single_blanks(F.filter(ls, lambda s: ~is_symbol_line(s))), "\n"))


def _single_blanks(ls: Column) -> Column:
    return F.transform(
        F.filter(F.arrays_zip(ls.alias("s"), F.concat(F.array(F.lit("")), ls).alias("p")), lambda r: r["s"].isNotNull() & ~((r["s"] == "") & (r["p"] == ""))), lambda r: r["s"]
    )


def collapse_lines(x: Column) -> Column:
    """Lines are stripped; a line that equals the one before goes; blank lines stay once, never first, and part equal lines."""
    ls = F.transform(lines_of(x), strip)
    before = F.concat(F.array(F.lit("")), ls)
    pairs = F.filter(F.arrays_zip(ls.alias("s"), before.alias("p")), lambda r: r["s"].isNotNull() & (r["s"] != r["p"]))
    return F.array_join(F.transform(pairs, lambda r: r["s"]), "\n")


def widest_of_progression(x: Column) -> Column:
    """Of three lines or more, each within the next, the last stays; each holding the next, the first; else all."""
    ls = F.filter(F.transform(lines_of(x), strip), lambda s: s != "")
    pairs = F.arrays_zip(F.slice(ls, 1, F.greatest(F.size(ls) - 1, F.lit(0))).alias("a"), F.slice(ls, 2, F.greatest(F.size(ls) - 1, F.lit(0))).alias("b"))
    grows, shrinks = F.forall(pairs, lambda r: F.contains(r["b"], r["a"])), F.forall(pairs, lambda r: F.contains(r["a"], r["b"]))
    return F.when(F.size(ls) < 3, x).when(grows, F.element_at(ls, -1)).when(shrinks, F.get(ls, F.lit(0))).otherwise(x)


def sentences_once(x: Column) -> Column:
    """A sentence goes if it equals the one before but for white space. Only the last part can be blank, as others end with their mark."""
    parts = F.filter(F.split(x, rf"(?<=[{ENDINGS}])", -1), lambda p: p != "")
    norms = F.transform(parts, lambda p: F.regexp_replace(p, WS + "+", ""))
    rows = F.arrays_zip(parts.alias("s"), norms.alias("n"), F.concat(F.array(F.lit("")), norms).alias("p"))
    kept = F.filter(rows, lambda r: r["s"].isNotNull() & ((r["n"] == "") | (r["n"] != r["p"])))
    return F.when(F.size(parts) < 2, x).otherwise(F.array_join(F.transform(kept, lambda r: r["s"]), ""))


def single_gaps(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)\n\s*\n+", "\n\n")


def _repeated(passes: int):
    def run(t: str | None) -> str:
        for _ in range(passes):
            before, t = t, cleaned(t)
            if t == before:  # a further pass gives the same
                break
        return t or ""

    return run


def clean_array(texts: Column, passes: int = 1) -> Column:
    """Whole cleaning of each text of an array. It isn't idempotent, so the number of passes matters."""
    one = _repeated(passes)

    @F.pandas_udf(ArrayType(StringType()))
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda ts: [] if ts is None else [one(t) for t in ts])

    return run(texts)


def clean(x: Column, passes: int = 1) -> Column:
    """Whole cleaning of a text. The steps above, nested in one expression, would be computed over and over; one function computes each once."""
    one = _repeated(passes)

    @F.pandas_udf(StringType())
    def run(x: pd.Series) -> pd.Series:
        return x.map(one)

    return run(x)


#: Characters that a task turns at once where whole texts come and go; a fixed value.
SLICE = 1 << 22


def clean_rows(df: DataFrame, key: str, text: str, passes: int = 1) -> DataFrame:
    """key, text: clean() of each row's text, some million characters at a time, so that a task's memory doesn't grow with the rows of a batch."""
    one = _repeated(passes)
    rows = df.select(key, F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size, first = [], 0, 0
            for i, t in enumerate(batch.column(1)):
                t = t.as_py()
                out.append(one(t))
                size += len(t or "")
                if size > SLICE or i + 1 == len(batch):
                    yield pa.record_batch([batch.column(0).slice(first, len(out)), pa.array(out, pa.string())], batch.schema.names)
                    out, size, first = [], 0, i + 1

    return rows.mapInArrow(run, rows.schema)
