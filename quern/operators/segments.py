"""From texts to segments: blocks, pieces of bounded length, dense ids. All work on arrays inside a row, so nothing is shuffled."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import text as X

#: Characters of a piece; a fixed value. Characters that are handed on at once.
PIECE, SLICE = 220, 1 << 20
#: What text.strip() takes for space; Python's own strip() also takes separators of files and records.
_SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def slices(block: Column, size: int = PIECE) -> Column:
    """Stripped slices of size characters, without blank ones. One pass cuts them all: to look each up by its place would read the block, and work it out if
    it is an expression, over and over."""
    parts = F.regexp_extract_all(block, F.lit(f"(?s)(.{{1,{size}}})"), F.lit(1))
    return F.filter(F.transform(parts, X.strip), lambda s: s != "")


_TO_MARK = re.compile(rf"[^{X.ENDINGS}{X.CLOSINGS}]*[{X.ENDINGS}{X.CLOSINGS}]|[^{X.ENDINGS}{X.CLOSINGS}]+")
_BETWEEN_BLOCKS = re.compile(r"\n\s*\n+")


def _packed(parts: list[str], size: int) -> list[str]:
    out, held, n = [], [], 0
    for p in parts:
        if held and n + len(p) > size:
            out.append("".join(held))
            held, n = [], 0
        held.append(p)
        n += len(p)
    return [s for s in (x.strip() for x in [*out, "".join(held)]) if s]


def _sentences(block: str) -> list[str]:
    """Parts that end with a mark, the last one maybe without, stripped; blank ones are none."""
    return [s for s in (p.strip() for p in _TO_MARK.findall(block)) if s]


def _pieces(block: str, size: int) -> list[str]:
    b = block.strip()
    if len(b) <= size:
        return [b] if b else []
    parts = _sentences(b)
    if len(parts) > 1:
        return _packed(parts, size)
    return [s for s in (b[i : i + size].strip() for i in range(0, len(b), size)) if s]


def packed_sentences(block: Column, size: int = PIECE) -> Column:
    """Neighbouring sentences joined without separator while they fit; one that is too long stays whole. A native fold would copy what it has at
    each step."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda b: [] if b is None else _packed(_sentences(b), size))

    return run(block)


def sentences(block: Column) -> Column:
    """Parts that end with a mark, the last one maybe without, stripped; blank ones are none."""
    marks = X.ENDINGS + X.CLOSINGS
    parts = F.regexp_extract_all(block, F.lit(f"([^{marks}]*[{marks}]|[^{marks}]+)"), F.lit(1))
    return F.filter(F.transform(parts, X.strip), lambda s: s != "")


def sentence_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos, s: a row for each of sentences(), cut in one pass and handed on in slices of some million characters. As an array that is exploded, an
    optimiser that filters empty arrays first would cut them anew for each filter."""
    rows = df.select(key, F.col(text).cast("string").alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, places, said, held = [], [], [], 0

            def cut() -> pa.RecordBatch:
                return pa.record_batch([batch.column(0).take(pa.array(at, pa.int64())), pa.array(places, pa.int32()), pa.array(said, pa.string())], [key, "pos", "s"])  # noqa: B023

            for i in range(len(batch)):
                pos = 0
                for m in _TO_MARK.finditer(batch.column(1)[i].as_py() or ""):
                    if s := m[0].strip(_SPACE):
                        at.append(i)
                        places.append(pos)
                        said.append(s)
                        pos, held = pos + 1, held + len(s) + 16
                        if held > SLICE:
                            yield cut()
                            at, places, said, held = [], [], [], 0
            if at:
                yield cut()

    return rows.mapInArrow(run, T.StructType([rows.schema[key], T.StructField("pos", T.IntegerType()), T.StructField("s", T.StringType())]))


def pieces(block: Column, size: int = PIECE) -> Column:
    """A block as pieces: as it is if short, else sentences packed, else, of a single sentence, slices."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda b: [] if b is None else _pieces(b, size))

    return run(block)


def numbered(df: DataFrame, segments: Column, *keys: str) -> DataFrame:
    """A row for each segment, with ids from 1 on."""
    return df.select(*keys, F.posexplode(segments).alias("pos", "text")).select(*keys, (F.col("pos") + 1).cast("long").alias("id"), "text")


def _cut(size: int, decode: bool, passes: int, bare: bool):
    """key, id, text of the pieces of texts: all steps in one hop, without a shuffle or window, as a text's pieces follow each other."""

    def of(text: str) -> Iterator[str]:
        text = X.decoded(text, bare) if decode else text
        for _ in range(passes):
            text = X.cleaned(text, bare)
        for block in _BETWEEN_BLOCKS.split(text.strip()):
            for piece in _pieces(X.cleaned(block, bare), size):
                if said := X.cleaned(piece, bare):
                    yield said

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids, texts = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                got = list(of(text or ""))
                rows += [i] * len(got)
                ids += range(1, len(got) + 1)
                texts += got
            yield pa.record_batch([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(ids, pa.int64()), pa.array(texts, pa.string())], [batch.schema.names[0], "id", "text"])

    return run


def split_blocks(df: DataFrame, key: str, text: str, size: int = PIECE, decode: bool = False, passes: int = 0, bare: bool = True) -> DataFrame:
    """key, id, text: pieces of a text's blocks, cleaned before and after they are cut; empty ones are dropped. decode: entities are decoded
    first; passes: cleanings of the whole text before that; bare: entities need no semicolon."""
    rows = df.select(key, F.col(text).cast("string").alias("_a"))
    return rows.mapInArrow(_cut(size, decode, passes, bare), T.StructType([rows.schema[key], T.StructField("id", T.LongType()), T.StructField("text", T.StringType())]))


def text_segments(df: DataFrame, key: str, text: str) -> DataFrame:
    """Plain texts: one cleaning, then those of split_blocks()."""
    return split_blocks(df, key, text, passes=1)


def web_segments(df: DataFrame, key: str, html: str, bare: bool = True) -> DataFrame:
    """Pages: scripts and styles go, tags part lines, entities are decoded; then as plain texts."""
    return split_blocks(df.select(key, X.without_tags(X.without_scripts(F.col(html)), "\n").alias("_text")), key, "_text", decode=True, passes=1, bare=bare)


def transcript_segments(df: DataFrame, key: str, segments: str) -> DataFrame:
    """array<struct<id, start, end, text>> cleaned once. An id that is given stays; else it is the place among the kept ones."""
    texts = F.transform(segments, lambda r: X.strip(F.coalesce(r["text"], F.lit(""))))
    both = df.select(key, F.col(segments).alias("r"), X.clean_array(texts).alias("t"))
    out = both.select(key, F.posexplode(F.filter(F.arrays_zip("r", "t"), lambda r: r["t"] != "")).alias("pos", "x"))
    return out.select(key, F.coalesce(F.col("x.r.id"), (F.col("pos") + 1).cast("long")).alias("id"), F.col("x.r.start").alias("start"), F.col("x.r.end").alias("end"), F.col("x.t").alias("text"))


def document_record(segments: DataFrame, key: str, source_type: str, language: Column | None = None) -> DataFrame:
    """Normalised documents: source type, language, whether a segment has both times, and the segments by id."""
    has = {c for c in segments.columns}
    start, end = (F.col(c) if c in has else F.lit(None).cast("double").alias(c) for c in ("start", "end"))
    timed = F.col("start").isNotNull() & F.col("end").isNotNull() if {"start", "end"} <= has else F.lit(False)
    row = F.struct("id", start, end, "text")
    return (
        segments.groupBy(key).agg(F.bool_or(timed).alias("has_timestamps"), F.array_sort(F.collect_list(row)).alias("segments"))
        .select(key, F.lit(source_type).alias("source_type"), F.coalesce(language if language is not None else F.lit(None), F.lit("auto")).alias("language"), "has_timestamps", F.lit("main").alias("normalization_plan"), "segments")
    )


def has_timestamps(segments: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """key, has_timestamps: whether any segment has both times."""
    return segments.groupBy(key).agg(F.bool_or(F.col(start).isNotNull() & F.col(end).isNotNull()).alias("has_timestamps"))


def transcript_texts(segments: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """key, text: the segments' texts that aren't blank, a line each, in order."""
    row = F.struct(F.col(order).alias("o"), X.strip(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    lines = F.transform(F.array_sort(F.collect_list(row)), lambda r: r["t"])
    return segments.groupBy(key).agg(X.strip(F.array_join(F.filter(lines, lambda s: s != ""), "\n")).alias("text"))
