"""Texts, subtitles and reports from segments; and subtitles back to text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import scalars as S
from quern.functions import text as X


def _by_place(value: Column) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct("pos", value.alias("v")))), lambda r: r["v"])


def _sides() -> tuple[Column, Column]:
    return X.strip(F.coalesce("text", F.lit(""))), X.strip(F.coalesce("translation", F.lit("")))


def translated_text(segments: DataFrame, key: str) -> DataFrame:
    """key, translated: the translations that aren't blank, a line each, by pos."""
    _, tgt = _sides()
    return segments.select(key, "pos", tgt.alias("t")).groupBy(key).agg(X.strip(F.array_join(F.filter(_by_place(F.col("t")), lambda s: s != ""), "\n")).alias("translated"))


def bilingual_text(segments: DataFrame, key: str) -> DataFrame:
    """key, bilingual: of each segment its id in brackets, text and translation, parted by blank lines."""
    src, tgt = _sides()
    part = F.concat(F.lit("["), F.coalesce(F.col("id").cast("string"), F.lit("None")), F.lit("]\n"), F.col("s"), F.lit("\n"), F.col("t"), F.lit("\n"))
    rows = segments.select(key, "pos", "id", src.alias("s"), tgt.alias("t")).where("s <> '' OR t <> ''")
    return rows.groupBy(key).agg(F.regexp_replace(F.array_join(_by_place(part), "\n"), r"(?U)\s+\z", "").alias("bilingual"))


def cues(segments: DataFrame, key: str, mode: str = "translated") -> DataFrame:
    """key, cue, timing, body: segments with both times and a text, numbered by pos. mode: "translated" (else the text) or "bilingual"."""
    from pyspark.sql import Window

    src, tgt = _sides()
    body = S.first_truthy(tgt, src) if mode == "translated" else F.array_join(F.filter(F.array(src, tgt), lambda s: s != ""), "\n")
    timed = segments.where(F.col("start").isNotNull() & F.col("end").isNotNull()).withColumn("body", body).where("body <> ''")
    number = F.row_number().over(Window.partitionBy(key).orderBy("pos"))
    return timed.select(key, number.cast("long").alias("cue"), F.concat(S.srt_timestamp(F.col("start")), F.lit(" --> "), S.srt_timestamp(F.col("end"))).alias("timing"), "body")


def srt(segments: DataFrame, key: str, mode: str = "translated") -> DataFrame:
    """key, srt: whole subtitle files; keys without cues have none."""
    part = F.concat(F.col("cue").cast("string"), F.lit("\n"), F.col("timing"), F.lit("\n"), F.col("body"), F.lit("\n"))
    return cues(segments, key, mode).withColumnRenamed("cue", "pos").withColumn("cue", F.col("pos")).groupBy(key).agg(F.array_join(_by_place(part), "\n").alias("srt"))


def subtitle_text(content: Column, header: bool) -> Column:
    """Text of a .vtt (header) or .srt file. A line is dropped if it equals the line kept last, as it is after tags were taken from that one."""
    sep = r"\." if header else ","
    timing = rf"(?U)^\d{{2}}:\d{{2}}:\d{{2}}{sep}\d{{3}}\s-->\s\d{{2}}:\d{{2}}:\d{{2}}{sep}\d{{3}}"
    ls = F.transform(X.lines_of(content), X.strip)
    keep = lambda s: (s != "") & ~F.rlike(s, F.lit(r"^\p{Nd}+$")) & ~F.rlike(s, F.lit(timing)) & (F.lit(True) if not header else (s != "WEBVTT") & ~F.startswith(s, F.lit("NOTE")) & ~F.startswith(s, F.lit("STYLE")))
    plain = lambda s: X.without_tags(s, "")

    def add(acc: Column, s: Column) -> Column:
        again = acc["any"] & (acc["last"] == s)
        return F.struct(F.when(again, acc["out"]).otherwise(F.concat(acc["out"], F.array(plain(s)))).alias("out"), F.when(again, acc["last"]).otherwise(plain(s)).alias("last"), F.lit(True).alias("any"))

    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("last"), F.lit(False).alias("any"))
    return F.array_join(F.aggregate(F.filter(ls, keep), start, add, lambda acc: acc["out"]), "\n")


def progress_line(p: str = "") -> Column:
    """One line of a report; parts without figures are left out."""
    c = lambda n: F.col(f"{p}{n}")
    return F.concat_ws(
        " | ",
        c("name"),
        F.concat(c("step").cast("string"), F.lit("/"), c("total").cast("string")),
        F.concat(S.fixed(c("percent"), 1), F.lit("%")),
        F.concat(F.lit("avr_loss "), S.fixed(c("avr_loss"), 3)),
        F.concat(F.lit("ETA "), S.eta(c("eta_seconds"))),
        F.concat(F.lit("VRAM "), c("dedicated_used_mb").cast("string"), F.lit("/"), c("dedicated_total_mb").cast("string"), F.lit("MB")),
        F.coalesce(F.concat(F.lit("Shared(train) "), c("shared_train_mb").cast("string"), F.lit("MB")), F.concat(F.lit("Shared "), c("shared_used_mb").cast("string"), F.lit("MB"))),
        F.concat(F.lit("speed x"), S.fixed(c("speed_ratio"), 2)),
        F.concat(F.lit("risk "), c("risk")),
        c("status"),
    )


def translated_records(rows: DataFrame, key: str, source_type: str, source: str = "auto", target: str = "zh", budget: int = 1200, refine_budget: int = 900) -> DataFrame:
    """One record for each document from the rows of translate_documents(): languages, budgets, what became of the refinement, and the segments
    by id. Times that a run took are left null, as they differ from run to run."""
    status = {c: F.first(c).alias(c) for c in ("refine_status", "refine_error", "refine_skipped_noisy", "refine_partial_missing", "refine_chunk_size_used")}
    timed = F.bool_or(F.col("start").isNotNull() & F.col("end").isNotNull()).alias("has_timestamps")
    out = rows.groupBy(key).agg(timed, *status.values(), F.array_sort(F.collect_list(F.struct("id", "start", "end", "text", "translation"))).alias("segments"))
    none = F.lit(None)
    return out.select(
        key, F.lit(source_type).alias("source_type"), F.lit(source).alias("source_lang"), F.lit(target).alias("target_lang"), "has_timestamps", F.lit("ok").alias("translate_status"),
        none.cast("string").alias("translate_error"), none.cast("long").alias("translate_elapsed_ms"), F.lit(budget).alias("translate_max_chars_used"), (F.col("refine_status") != "not_requested").alias("refine_requested"),
        (F.col("refine_status") == "applied").alias("refine_applied"), "refine_status", "refine_error", none.cast("long").alias("refine_elapsed_ms"), "refine_chunk_size_used", F.lit(refine_budget).alias("refine_max_chars_used"),
        "refine_skipped_noisy", "refine_partial_missing", F.lit("main").alias("plan"), "segments",
    )
