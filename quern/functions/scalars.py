"""Scalar functions on numbers, paths and URLs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _padded(n: Column, width: int = 2) -> Column:
    """Zeros in front up to width; longer numbers stay whole, which lpad would cut."""
    s = n.cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def srt_timestamp(seconds: Column) -> Column:
    """HH:MM:SS,mmm; milliseconds are rounded half to even, hours have no limit; null stays null."""
    ms = F.bround(seconds.cast("double") * 1000).cast("long")
    part = lambda unit, of: F.pmod((ms - F.pmod(ms, F.lit(unit))) / unit, F.lit(of)).cast("long")
    hours = ((ms - F.pmod(ms, F.lit(3_600_000))) / 3_600_000).cast("long")
    return F.concat(_padded(hours), F.lit(":"), _padded(part(60_000, 60)), F.lit(":"), _padded(part(1000, 60)), F.lit(","), _padded(F.pmod(ms, F.lit(1000)), 3))


def eta(seconds: Column) -> Column:
    """XhMMm, XmSSs or Xs of seconds rounded half to even, never below 0."""
    s = F.greatest(F.bround(seconds.cast("double")).cast("long"), F.lit(0))
    s = F.when(seconds.isNotNull(), s)
    h, m, r = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    return F.when(h > 0, F.concat(h.cast("string"), F.lit("h"), _padded(m), F.lit("m"))).when(m > 0, F.concat(m.cast("string"), F.lit("m"), _padded(r), F.lit("s"))).otherwise(F.concat(r.cast("string"), F.lit("s")))


def fixed(x: Column, places: int) -> Column:
    """A number with so many decimal places, rounded from its exact binary value, half to even; null stays null. Java's format rounds the shortest decimal
    that stands for the number, half up."""

    @F.pandas_udf("string")
    def run(v: pd.Series) -> pd.Series:
        return v.map(lambda n: f"{n:.{places}f}")

    return F.when(x.isNotNull(), run(x.cast("double")))


def megabytes(n: Column) -> Column:
    return F.bround(n.cast("double") / 1048576).cast("long")


def first_truthy(*cols: Column) -> Column:
    """The first that is neither null nor empty; else empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cols), F.lit(""))


def form_encoded(x: Column) -> Column:
    """As HTML forms encode, with "~" as it is and "*" encoded."""
    return F.replace(F.replace(F.url_encode(x), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def component_encoded(x: Column) -> Column:
    """As JavaScript encodes a URI component: blanks become %20, and ! ' ( ) ~ * stay."""
    out = F.replace(F.url_encode(x), F.lit("+"), F.lit("%20"))
    for code, char in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def wsl_path(x: Column) -> Column:
    s = F.translate(F.regexp_replace(F.regexp_replace(x, r"(?U)^\s+|\s+\z", ""), '^"+|"+$', ""), "\\", "/")
    return F.when(F.rlike(s, F.lit("^[A-Za-z]:/")), F.concat(F.lit("/mnt/"), F.lower(F.substring(s, 1, 1)), F.substr(s, F.lit(3)))).otherwise(s)


def subtitles_filter(path: Column) -> Column:
    """The path inside a filter argument: separators and quotes are escaped."""
    s = F.replace(path, F.lit("\\"), F.lit("/"))
    for c in ":',[]":
        s = F.replace(s, F.lit(c), F.lit("\\" + c))
    return F.concat(F.lit("subtitles='"), s, F.lit("'"))


#: Parts of a host that tell a platform, and the language asked for on one, else on all others; fixed values.
PLATFORMS = [("youtube", ["youtube.com", "youtu.be", "youtube-nocookie.com"]), ("bilibili", ["bilibili.com", "b23.tv"])]
PLATFORM_LANGUAGE, OTHER_LANGUAGE = ("bilibili", "zh-CN"), "en"


def platform(url: Column) -> Column:
    host = F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1), F.lit("")))
    out = F.lit("unknown")
    for name, parts in reversed(PLATFORMS):
        fits = F.lit(False)
        for p in parts:
            fits = fits | F.contains(host, F.lit(p))
        out = F.when(fits, name).otherwise(out)
    return out


def subtitle_language(url: Column, asked: Column | None = None) -> Column:
    """The language asked for; else that of the platform; none on unknown platforms, which have no subtitles to fetch."""
    on = platform(url)
    usual = F.when(on == PLATFORM_LANGUAGE[0], PLATFORM_LANGUAGE[1]).when(on != "unknown", OTHER_LANGUAGE)
    return F.when(on != "unknown", F.coalesce(asked, usual)) if asked is not None else usual


def language(own: Column, source: Column, override: str = "auto") -> Column:
    """The override unless it is "auto"; else the first of the two that isn't empty; else "auto"."""
    return F.lit(override) if override != "auto" else F.coalesce(F.nullif(own, F.lit("")), F.nullif(source, F.lit("")), F.lit("auto"))


def suffix_type(source: Column) -> Column:
    """Reader for a source: URLs are web; else by the suffix; anything unknown is text."""
    suffix = F.lower(F.regexp_extract(source, r"(\.[^./\\]+)$", 1))
    return (
        F.when(F.rlike(source, F.lit(r"^https?://")), "web").when(suffix == ".json", "json").when(suffix == ".pdf", "pdf").when(suffix == ".docx", "docx")
        .when(suffix.isin(".html", ".htm"), "web").otherwise("text")
    )


def hours_a_month(minutes: Column, times: Column) -> Column:
    return minutes * times / 60


def payback(setup_hours: Column, hourly: Column, saved_hours: Column) -> Column:
    """Months until a setup has paid; null if nothing is saved."""
    return F.when(saved_hours * hourly > 0, setup_hours * hourly / (saved_hours * hourly))


def payback_verdict(months: Column) -> Column:
    return F.when(months < 3, "worth").when(months > 6, "not worth").when(months.isNotNull(), "depends").otherwise("not worth")


def risk(shared: Column, free: Column, ratio: Column) -> tuple[Column, Column]:
    """Risk band and its reasons from shared and free megabytes and the ratio of speeds. A band never falls; a warning that doesn't raise the
    band gives no reason, but for shared memory."""
    say = lambda c, text: F.when(c, text)
    s1, s2, s3 = (F.coalesce(shared >= n, F.lit(False)) for n in (1024, 512, 300))
    f1, f2 = (F.coalesce(free <= n, F.lit(False)) for n in (512, 1024))
    r1, r2 = (F.coalesce(ratio >= n, F.lit(False)) for n in (1.6, 1.35))
    high_before_ratio = s1 | f1
    band = F.when(s1 | f1 | r1, "high").when(s2 | f2 | r2, "warn").otherwise("normal")
    reasons = F.concat_ws(
        ", ",
        say(s3, F.concat(F.lit("shared "), shared.cast("string"), F.lit("MB"))),
        say(f1 | (f2 & ~s1), F.concat(F.lit("free "), free.cast("string"), F.lit("MB"))),
        say(r1 | (r2 & ~high_before_ratio), F.concat(F.lit("speed x"), fixed(ratio, 2))),
    )
    return band, F.when(reasons == "", "within expected range").otherwise(reasons)
