"""Readers and writers. Files come by Spark's own readers, so any store that Spark knows will do; what needs a parser goes through binary files
and a partition function."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quern.functions import scalars as S
from quern.functions import text as X
from quern.operators import emit, segments

SEGMENT = "struct<id:bigint,start:double,end:double,text:string>"
TRANSCRIPT = f"source string, model string, device string, compute_type string, language string, source_lang string, language_probability double, duration double, text string, segments array<{SEGMENT}>"
#: Lists that loosely structured JSON may keep its items in, in the order in which they are looked for; fixed values.
LISTS = ["blocks", "items", "lines", "paragraphs", "texts"]


def texts(spark: SparkSession, path: str) -> DataFrame:
    """path, text of whole files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRANSCRIPT).json(path, multiLine=True).withColumn("path", F.col("_metadata.file_path"))


def web_pages(spark: SparkSession, path: str) -> DataFrame:
    return texts(spark, path).withColumnRenamed("text", "html")


def generic_json(df: DataFrame, key: str, json: str) -> DataFrame:
    """key, kind, id, start, end, text of loosely structured JSON texts: a list of segments first, then the first of LISTS that is a list, then
    a bare list; else the JSON itself is cleaned and split as a text (indented by two, as it is printed)."""
    v = F.try_parse_json(F.col(json))
    get = lambda p, t: F.try_variant_get(F.col("_v"), p, t)
    items = F.coalesce(*(get(f"$.{k}", "array<variant>") for k in LISTS), get("$", "array<variant>"))
    base = df.select(key, F.col(json).alias("_j"), v.alias("_v")).withColumns({"_s": get("$.segments", "array<variant>"), "_i": items})
    kind = F.when(F.col("_s").isNotNull(), "transcript").when(F.col("_i").isNotNull(), "json").otherwise("text")
    base = base.withColumn("kind", kind)
    of = lambda x, p, t: F.try_variant_get(x, p, t)
    as_text = lambda x: F.when(F.startswith(F.schema_of_variant(x), F.lit("OBJECT")), S.first_truthy(*(of(x, f"$.{k}", "string") for k in ("text", "content", "value")))).otherwise(F.coalesce(of(x, "$", "string"), F.lit("None")))
    rows = F.transform(F.coalesce("_s", "_i"), lambda x: F.struct(of(x, "$.id", "bigint").alias("id"), of(x, "$.start", "double").alias("start"), of(x, "$.end", "double").alias("end"), as_text(x).alias("text")))
    listed = base.where("kind <> 'text'").withColumn("_rows", F.transform(rows, lambda r: F.struct(F.when(F.col("kind") == "transcript", r["id"]).alias("id"), r["start"].alias("start"), r["end"].alias("end"), r["text"].alias("text"))))
    out = segments.transcript_segments(listed.withColumn("_key", F.struct(F.col(key).alias("k"), "kind")), "_key", "_rows")
    out = out.select(F.col("_key.k").alias(key), F.col("_key.kind").alias("kind"), "id", "start", "end", "text")
    plain = segments.text_segments(base.where("kind = 'text'").select(key, printed(F.col("_j")).alias("_t")), key, "_t")
    none = F.lit(None).cast("double")
    return out.unionByName(plain.select(key, F.lit("text").alias("kind"), "id", none.alias("start"), none.alias("end"), "text"))


@F.pandas_udf(StringType())
def printed(x: pd.Series) -> pd.Series:
    import json

    def one(t):
        try:
            return json.dumps(json.loads(t), ensure_ascii=False, indent=2)
        except (TypeError, ValueError):
            return t

    return x.map(one)


def word_texts(data: bytes) -> list[str]:
    """Paragraphs of a word processor's file, then the rows of its tables with cells parted by bars."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml")).find(f"{w}body")
    marks = {f"{w}br": "\n", f"{w}tab": "\t"}
    said = lambda p: "".join(marks.get(e.tag, e.text or "") for e in p.iter() if e.tag in marks or e.tag == f"{w}t")
    rows = [[["\n".join(said(p) for p in c.findall(f"{w}p"))] for c in r.findall(f"{w}tc")] for t in body.findall(f"{w}tbl") for r in t.findall(f"{w}tr")]
    return [*(said(p) for p in body.findall(f"{w}p")), *("\x1f".join(c[0] for c in r) for r in rows)]


def pdf_texts(data: bytes) -> list[str]:
    """Texts of a PDF's pages; needs the pypdf package."""
    from pypdf import PdfReader

    return [p.extract_text() or "" for p in PdfReader(io.BytesIO(data)).pages]


def documents(spark: SparkSession, path: str, parse=word_texts) -> DataFrame:
    """path, id, text: segments of binary documents."""
    return document_segments(spark.read.format("binaryFile").load(path).select("path", "content"), parse)


def document_segments(files: DataFrame, parse=word_texts) -> DataFrame:
    """path, id, text of documents (path, content). Parts are cleaned, empty ones dropped, the rest joined by blank lines, split as texts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"path": f["path"], "parts": [parse(bytes(c)) for c in f["content"]]})

    parts = files.select("path", "content").mapInPandas(run, "path string, parts array<string>")
    cells = lambda p: F.array_join(F.filter(X.clean_array(F.split(p, "\x1f")), lambda c: c != ""), " | ")
    cleaned = parts.select("path", F.posexplode("parts").alias("n", "part")).withColumn("part", cells(F.col("part"))).where("part <> ''")
    joined = cleaned.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "part"))), lambda r: r["part"]), "\n\n").alias("_t"))
    return segments.split_blocks(joined, "path", "_t")


def subtitles(spark: SparkSession, path: str) -> DataFrame:
    """folder, path, text: of each folder's .vtt and .srt files the one preferred, as plain text."""
    return chosen_subtitles(texts(spark, path))


def chosen_subtitles(files: DataFrame) -> DataFrame:
    """folder, path, text of subtitle files (path, text): of each folder one, .vtt before .srt, then by name."""
    files = files.withColumn("rank", F.when(F.endswith("path", F.lit(".vtt")), 0).when(F.endswith("path", F.lit(".srt")), 1)).where("rank IS NOT NULL")
    one = files.groupBy(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")).agg(F.min_by(F.struct("path", "text", "rank"), F.struct("rank", "path")).alias("f"))
    text = F.when(F.col("f.rank") == 0, emit.subtitle_text(F.col("f.text"), True)).otherwise(emit.subtitle_text(F.col("f.text"), False))
    return one.select("folder", F.col("f.path").alias("path"), text.alias("text"))


def logs(spark: SparkSession, folder: str, pattern: str = "*.wandb") -> DataFrame:
    """path, folder, changed, content of all log files below a folder; unreadable ones are skipped."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).load(folder)
    return read.select("path", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"), F.col("modificationTime").alias("changed"), "content")


def counters(df: DataFrame, json: str) -> DataFrame:
    """path, value rows of performance counters in JSON."""
    rows = F.from_json(F.col(json), "array<struct<Path:string,CookedValue:double>>")
    return df.select(F.explode(rows).alias("c")).select(F.col("c.Path").alias("path"), F.coalesce("c.CookedValue", F.lit(0.0)).alias("value"))


def models(spark: SparkSession, path: str) -> DataFrame:
    """A model list, with pos, the place in its file."""
    return listed_models(texts(spark, path), "text")


def listed_models(df: DataFrame, json: str) -> DataFrame:
    """pos and the fields of the models of JSON lists."""
    from quern.operators.router import MODEL

    fields = ", ".join(f"{n}: {t}" for n, t in (c.split(" ", 1) for c in MODEL.split(", ")))
    return df.select(F.posexplode(F.from_json(json, f"array<struct<{fields}>>")).alias("pos", "m")).select("pos", "m.*")


def catalogues(spark: SparkSession, path: str) -> DataFrame:
    """The models of nested catalogues of providers, with the path of each."""
    from quern.operators.router import catalogue_texts

    return catalogue_texts(texts(spark, path), "text", "path")


def checkpoint(spark: SparkSession, path: str, key: str = "doc") -> DataFrame | None:
    """What earlier runs have translated: key, id, translation of the newest whole version under path; none where there is none, or where its
    files can't be read, as nothing is lost by translating again."""
    from pyspark.errors import PySparkException

    for version in reversed(checkpoint_versions(spark, path)):
        try:
            found = spark.read.schema(f"{key} string, id long, translation string").option("ignoreCorruptFiles", True).parquet(f"{path}/{version}")
            found.agg(F.count("translation")).collect()  # reads every file once; a broken one shows here, not halfway through a run
            return found.where(F.col("id").isNotNull() & (F.coalesce("translation", F.lit("")) != ""))
        except PySparkException:
            continue
    return None


def checkpoint_versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the whole versions under path, oldest first. A version counts once it is marked as whole."""
    return [n for n in folders(spark, path) if n.startswith("v") and exists(spark, f"{path}/{n}/_SUCCESS")]


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _at(spark, path)
    return fs.exists(at)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if there is no such folder."""
    at, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()) if fs.exists(at) else []


def mark_whole(spark: SparkSession, path: str) -> None:
    """Marks a version that was written in parts."""
    at, fs = _at(spark, f"{path}/_SUCCESS")
    fs.create(at, True).close()


def drop_versions(spark: SparkSession, path: str, names: list[str]) -> None:
    for n in names:
        at, fs = _at(spark, f"{path}/{n}")
        fs.delete(at, True)


def config(spark: SparkSession, path: str) -> dict:
    """A small TOML or YAML file as a dict, read by Spark so that it may lie in any store."""
    import tomllib

    text = texts(spark, path).first().text
    if path.endswith(".toml"):
        return tomllib.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML needs the PyYAML package") from e
    return yaml.safe_load(text) or {}


def read(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """Segments (path, id, text, and times where there are any) of files by kind, or by the suffix of the path."""
    kind = kind or spark.range(1).select(S.suffix_type(F.lit(path))).first()[0]
    if kind == "text":
        return segments.text_segments(texts(spark, path), "path", "text")
    if kind == "web":
        return segments.web_segments(web_pages(spark, path), "path", "html")
    if kind == "transcript":
        return segments.transcript_segments(transcripts(spark, path), "path", "segments")
    if kind in ("json", "ocr"):
        out = generic_json(texts(spark, path), "path", "text")
        return out.withColumn("kind", F.lit("ocr")) if kind == "ocr" else out
    if kind in ("docx", "pdf"):
        return documents(spark, path, word_texts if kind == "docx" else pdf_texts)
    raise ValueError(f"unknown kind of source: {kind}")


def write_text(df: DataFrame, path: str, key: str, value: str) -> None:
    """A folder for each key, with its text; keys without text have none."""
    df.where(F.col(value) != "").select(key, value).write.mode("overwrite").partitionBy(key).text(path)


def transcript_records(segments_: DataFrame, key: str, order: str, **about: str) -> DataFrame:
    """One record for each transcript: what is said about all of it, its whole text, and its segments in order."""
    whole = segments.transcript_texts(segments_, key, order)
    row = F.struct(order, "start", "end", X.strip(F.coalesce("text", F.lit(""))).alias("text"))
    parts = segments_.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["text"].alias("text"))).alias("segments"))
    return whole.join(parts, key).select(key, *(F.lit(v).alias(n) for n, v in about.items()), "text", "segments")


def write_transcripts(records: DataFrame, path: str, key: str, debug: bool = False) -> None:
    """Records as JSON; with debug also their texts, and what is said about each without text and segments."""
    records.write.mode("overwrite").json(f"{path}/json")
    if debug:
        write_text(records, f"{path}/txt", key, "text")
        records.drop("text", "segments").write.mode("overwrite").json(f"{path}/meta")


def write_documents(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").json(path)


def as_json(df: DataFrame, *cols: Column) -> DataFrame:
    return df.select(F.to_json(F.struct(*(cols or ["*"])), {"ignoreNullFields": "false"}).alias("json"))
