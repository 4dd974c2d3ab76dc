"""Rules over texts and paths: gates, flags, watch words, filler, file selection, redaction, search URLs."""

from __future__ import annotations

import functools
import json
import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quern.functions import markup
from quern.functions import scalars as S

#: Findings that fail a scan; fixed values.
SCAN_PHRASES = ["vulnerability", "injection", "malware", "secret found", "unsafe", "high risk", "medium risk", "critical"]

#: Patterns for the red flags of a code review. The flags are given in prose; the patterns are this module's reading of them.
RED_FLAGS = [
    ("fetches_urls", r"\b(curl|wget)\b"), ("sends_data", r"\b(upload|exfiltrat|requests\.post|post to)\b"), ("asks_credentials", r"(credential|api key|token|passphrase)"),
    ("reads_dotfiles", r"~/\.(ssh|aws|config)"), ("reads_memory_files", r"\b(memory|user|soul|identity)\.md\b"), ("decodes_base64", r"base64"), ("evaluates", r"\b(eval|exec)\s*\("),
    ("system_files", r"(/etc/|/usr/|/boot/)"), ("installs_packages", r"\b(pip|npm|apt) install\b"), ("calls_ip", r"https?://[0-9]{1,3}(\.[0-9]{1,3}){3}"),
    ("obfuscated", r"(obfuscat|minified)"), ("elevated", r"\bsudo\b"), ("browser_data", r"(cookie|session storage)"), ("credential_files", r"(\.netrc|id_rsa|\.pem\b)"),
]

#: Filler phrases and what replaces them; fixed values.
FILLER = [
    ("in order to", "to"), ("due to the fact that", "because"), ("at this point in time", "now"), ("in the event that", "if"), ("has the ability to", "can"), ("it is important to note that ", ""),
]

#: Categories that are never stored, and patterns for them (this module's reading).
NEVER_STORE = [
    ("credentials", r"(password|api[ _-]?key|secret|ssh-rsa)"), ("financial", r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b"), ("medical", r"(diagnos|medication)"), ("biometric", r"(fingerprint|voice pattern)"),
    ("third_parties", r"\b[a-z0-9._-]+@[a-z0-9-]+\.[a-z.]+\b"), ("locations", r"(home address|work address)"), ("access", r"(has access to|login for)"),
]

#: Engines: name, URL template, region; time bands and their parameters; fixed values.
ENGINES = [
    ("Baidu", "https://www.baidu.com/s?wd={keyword}", "cn"), ("Bing CN", "https://cn.bing.com/search?q={keyword}&ensearch=0", "cn"), ("Bing INT", "https://cn.bing.com/search?q={keyword}&ensearch=1", "cn"),
    ("360", "https://www.so.com/s?q={keyword}", "cn"), ("Sogou", "https://sogou.com/web?query={keyword}", "cn"), ("WeChat", "https://wx.sogou.com/weixin?type=2&query={keyword}", "cn"),
    ("Toutiao", "https://so.toutiao.com/search?keyword={keyword}", "cn"), ("Jisilu", "https://www.jisilu.cn/explore/?keyword={keyword}", "cn"), ("Google", "https://www.google.com/search?q={keyword}", "global"),
    ("Google HK", "https://www.google.com.hk/search?q={keyword}", "global"), ("DuckDuckGo", "https://duckduckgo.com/html/?q={keyword}", "global"), ("Yahoo", "https://search.yahoo.com/search?p={keyword}", "global"),
    ("Startpage", "https://www.startpage.com/sp/search?query={keyword}", "global"), ("Brave", "https://search.brave.com/search?q={keyword}", "global"), ("Ecosia", "https://www.ecosia.org/search?q={keyword}", "global"),
    ("Qwant", "https://www.qwant.com/?q={keyword}", "global"), ("WolframAlpha", "https://www.wolframalpha.com/input?i={keyword}", "global"),
]
PERIODS = {"hour": "qdr:h", "day": "qdr:d", "week": "qdr:w", "month": "qdr:m", "year": "qdr:y"}
#: The first engine for a goal and the others in order; fixed values.
GOALS = [
    ("research", ["Google Scholar", "Google", "Brave"]), ("programming", ["Google", "GitHub"]), ("privacy", ["DuckDuckGo", "Startpage", "Brave"]), ("news", ["Brave News", "Google News"]),
    ("knowledge", ["WolframAlpha", "Google"]), ("chinese", ["Google HK", "Bing"]), ("europe", ["Qwant", "Startpage"]), ("environment", ["Ecosia", "DuckDuckGo"]), ("unfiltered", ["Brave", "Startpage"]),
]


#: A word's boundary among ASCII's letters, digits and underscore. Java's own takes in all letters or these alone, by its version.
_BOUNDARY = r"(?:(?<![0-9A-Za-z_])(?=[0-9A-Za-z_])|(?<=[0-9A-Za-z_])(?![0-9A-Za-z_]))"


def scan_gate(output: Column, exit_code: Column | None = None) -> Column:
    """Whether a scan is clean: no finding named in its output, and no other exit code than 0."""
    clean = ~F.rlike(F.lower(output), F.lit("|".join(SCAN_PHRASES)))
    return clean if exit_code is None else clean & (exit_code == 0)


def flagged(df: DataFrame, key: str, text: str, patterns: list[tuple[str, str]] = RED_FLAGS) -> DataFrame:
    """key, flag for each pattern found, case aside; \\b is a boundary of ASCII words. The patterns sit in the projection: there is no join and no copy of
    the text."""
    low = F.lower(text)
    masked = F.regexp_replace(low, r"[^\x00-\x7f]", "\x01")  # other letters are no part of words; far cheaper than boundaries spelt out

    def has(p: str) -> Column:
        if r"\b" not in p:
            return F.rlike(low, F.lit(p))
        return F.rlike(masked, F.lit(p)) if p.isascii() and r"\p" not in p else F.rlike(low, F.lit(p.replace(r"\b", _BOUNDARY)))

    found = F.filter(F.array(*(F.when(has(p), n) for n, p in patterns)), lambda x: x.isNotNull())
    return df.select(key, F.explode(found).alias("flag"))


def without_filler(x: Column) -> Column:
    for phrase, by in FILLER:
        x = F.regexp_replace(x, f"(?i){phrase}", by)
    return x


def selected_files(files: DataFrame, exclude: list[str], path: str = "path", include: list[str] | None = None) -> DataFrame:
    """Files that include names, or that lie in a folder it names (all without include), and that no glob of exclude matches: "*" and "?" match
    within and across folders, and a match of a folder takes all below it."""
    import fnmatch

    patterns = [fnmatch.translate(g).removesuffix(r"\z").removesuffix(r"\Z") + r"(?:/.*)?$" for g in exclude]
    out = files
    if include is not None:
        here = F.col(path)
        out = out.where(functools.reduce(Column.__or__, ((here == p) | F.startswith(here, F.lit(p + "/")) for p in include), F.lit(False)))
    for p in patterns:
        out = out.where(~F.rlike(path, F.lit("^" + p)))
    return out


def engine_for(goal: Column, place: int = 0) -> Column:
    """The engine for a goal, or the one in a later place; null for unknown goals and places that aren't there."""
    by = F.create_map(*(x for g, names in GOALS for x in (F.lit(g), F.array(*map(F.lit, names)))))
    return F.get(F.try_element_at(by, goal), F.lit(place))


_TERM = re.compile(r'(-?\()|(\))|(-?)(?:(site|filetype|inurl|intitle|intext):)?(?:"([^"]*)"|([^\s()"]+))')


def _whole(said: str) -> str:
    """A pattern for words or a phrase, "*" standing for any word; where it begins or ends with a letter or digit, no word goes on there."""
    inner = r"\S+".join(r"\Q" + p.replace(r"\E", r"\E\\E\Q") + r"\E" if p else "" for p in said.split("*"))
    before = r"(?<![\p{L}\p{N}])" if said[:1].isalnum() else ""
    return before + inner + (r"(?![\p{L}\p{N}])" if said[-1:].isalnum() else "")


def search_filter(query: str, url: Column, title: Column, text: Column) -> Column:
    """A search engine's query as a predicate, case aside: whole words and "phrases" (in title or text), -excluded, a OR b, (groups), -(excluded groups), * for
    any word, low..high for a number between, and site:, filetype:, inurl:, intitle:, intext:. Terms side by side must all hold. A side of OR, or a group,
    without terms is as if it weren't there; a query without terms holds. Null columns count as empty."""
    terms, at = list(_TERM.finditer(query)), 0
    low = {n: F.lower(F.coalesce(c, F.lit(""))) for n, c in (("title", title), ("text", text), ("url", url))}
    host = F.regexp_extract(low["url"], r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", 1)
    file = F.regexp_extract(low["url"], r"^[^?#]*\.([a-z0-9]+)(?:[?#].*)?$", 1)

    def holds(where: Column, said: str, phrase: bool) -> Column:
        if (m := re.fullmatch(r"\$?(\d+)\.\.\$?(\d+)", said)) and not phrase:
            numbers = F.transform(F.regexp_extract_all(where, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.try_cast("long"))
            return F.exists(numbers, lambda x: F.coalesce((x >= int(m[1])) & (x <= int(m[2])), F.lit(False)))
        found = F.rlike(where, F.lit(_whole(said)))
        return found if "*" in said else F.contains(where, F.lit(said)) & found  # bytes are looked for first

    def term(m: re.Match) -> Column | None:
        minus, field, quoted, plain = m[3], m[4], m[5], m[6]
        said = (quoted if quoted is not None else plain).lower()
        if not said.strip() or (quoted is None and not field and said == "-"):
            return None
        if field == "site":
            out = (host == said) | F.endswith(host, F.lit("." + said))
        elif field == "filetype":
            out = file == said
        elif field:
            out = holds(low[field[2:]], said, quoted is not None)
        else:
            out = holds(low["title"], said, quoted is not None) | holds(low["text"], said, quoted is not None)
        return ~out if minus else out

    def ors() -> bool:
        return at < len(terms) and terms[at][6] == "OR" and not terms[at][3] and not terms[at][4]

    def either() -> Column | None:
        nonlocal at
        sides = [all_of()]
        while ors():
            at += 1
            sides.append(all_of())
        sides = [s for s in sides if s is not None]
        return functools.reduce(Column.__or__, sides) if sides else None

    def all_of() -> Column | None:
        nonlocal at
        out = []
        while at < len(terms) and not ors() and not terms[at][2]:
            m = terms[at]
            at += 1
            if m[1]:
                group = either()
                at += at < len(terms)  # its closing parenthesis
                out.append(~group if group is not None and m[1] == "-(" else group)
            else:
                out.append(term(m))
        out = [x for x in out if x is not None]
        return functools.reduce(Column.__and__, out) if out else None

    found = [either()]
    while at < len(terms):  # a closing parenthesis too many
        at += 1
        found.append(either())
    return functools.reduce(Column.__and__, [x for x in found if x is not None], F.lit(True))


def opening_patterns(df: DataFrame, text: str, words: int = 2, n: int = 20) -> DataFrame:
    """The n most common openings of texts, in lower case, with their numbers."""
    opening = F.regexp_extract(F.lower(text), r"^\s*(\S+" + r"\s+\S+" * (words - 1) + ")", 1)
    return df.select(opening.alias("opening")).where("opening <> ''").groupBy("opening").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "opening").limit(n)


def extracted_fields(html: Column, item: str, fields: list[str]) -> Column:
    """array<struct> of the elements of class item, each with the text of the first element within it of each field's class; null where there is none."""
    return markup.fields_of(html, f".{item}", {f: f".{f}" for f in fields})


#: Versions of a picture, by what their URLs hold, the preferred one first; fixed values.
VARIANTS = ["image_pre_watermark", "image_dld_watermark", "web-operation", "downsize_watermark"]


def preferred_variant(df: DataFrame, key: str, url: str, variants: list[str] = VARIANTS) -> DataFrame:
    """key, url: of each key the version that is preferred; unknown ones come last, equal ones by name."""
    rank = F.lit(len(variants))
    for i, v in reversed(list(enumerate(variants))):
        rank = F.when(F.contains(F.col(url), F.lit(v)), i).otherwise(rank)
    return df.groupBy(key).agg(F.min_by(url, F.struct(rank, F.col(url))).alias("url"))


#: Keys that are redacted: whole names, parts of lower-cased names, and, of credential profiles, the names that stay; fixed values.
EXACT, MARKERS = {"deviceId", "publicKeyPem", "privateKeyPem"}, ["token", "secret", "password", "cookie", "refresh", "api_key", "apikey", "access_token", "client_secret"]
STAYS = {"provider", "mode", "keyRef", "key_ref", "profile", "baseUrl", "baseURL", "model", "alias", "name", "id"}


def _redacted(value, auth: bool):
    if isinstance(value, list):
        return [_redacted(v, auth) for v in value]
    if not isinstance(value, dict):
        return value
    plain = (lambda k, v: k in STAYS or "keyref" in k.lower()) if auth else (lambda k, v: False)
    gone = (lambda k, v: not isinstance(v, dict | list)) if auth else (lambda k, v: k in EXACT or any(m in k.lower() for m in MARKERS))
    return {k: v if plain(k, v) else "REDACTED" if gone(k, v) else _redacted(v, auth) for k, v in value.items()}


def redacted(config: Column, auth: bool = False) -> Column:
    """JSON text with sensitive values replaced, at any depth; text that isn't JSON gives null, so nothing slips through. Numbers that JSON hasn't, or that
    are too large to keep, become null."""

    def number(said: str) -> float | None:
        x = float(said)
        return x if math.isfinite(x) else None

    @F.pandas_udf(StringType())
    def run(x: pd.Series) -> pd.Series:
        def one(t):
            try:
                return json.dumps(_redacted(json.loads(t, parse_float=number, parse_constant=number), auth), ensure_ascii=False)
            except (TypeError, ValueError):
                return None

        return x.map(one)

    return run(config)


def engines(spark) -> DataFrame:
    return spark.createDataFrame(ENGINES, "engine string, url string, region string")


def search_urls(keywords: DataFrame, spark, keyword: str = "keyword") -> DataFrame:
    """keyword, engine, region, url: every engine's template filled in. The catalogue is a constant array, exploded in place."""
    rows = F.array(*(F.struct(F.lit(n).alias("engine"), F.lit(u).alias("url"), F.lit(r).alias("region")) for n, u, r in ENGINES))
    out = keywords.select(keyword, S.component_encoded(F.col(keyword)).alias("_enc"), F.explode(rows).alias("e"))
    return out.select(keyword, "e.engine", "e.region", F.replace(F.col("e.url"), F.lit("{keyword}"), F.col("_enc")).alias("url"))


def timed_search(keyword: Column, period: Column) -> Column:
    by = F.create_map(*(F.lit(x) for kv in PERIODS.items() for x in kv))
    return F.concat(F.lit("https://www.google.com/search?q="), S.component_encoded(keyword), F.lit("&tbs="), F.element_at(by, period))
