"""Translation and refinement of segments by pluggable adapters, with checkpoints.

An adapter maps a list of texts (or a batch of segments) to its results; the ones that come with this module work offline and always give the
same. Documents stream through sorted partitions; a task holds one document. Base translation fails fast; refinement degrades: if it fails
for a document, its base translation stays.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as X

#: What parts the texts of one request; budgets in characters; a fixed value each.
SEPARATOR, BASE_BUDGET, REFINE_BUDGET, PAUSES = "<<<SEG_BREAK_PLAN_B>>>", 1200, 900, (1, 2, 4)
#: Characters that count as noise; a fixed value.
NOISE = "~～…!！?？♡❤♥🖤「」『』【】（）()"

Translator = Callable[[str, str, str], str]
Refiner = Callable[[list[dict]], str]


def offline_translator(text: str, source: str, target: str) -> str:
    """Stands for a translation service: marks each line with the target language. Separators stay."""
    return "\n".join(f"[{target}] {line}" if line.strip() and SEPARATOR not in line else line for line in text.split("\n"))


def offline_refiner(batch: list[dict]) -> str:
    """Stands for a refining model: answers in its protocol, with blanks collapsed."""
    return "\n".join(f"REFINE::{s['id']}::{' '.join((s['translation'] or '').split())}" for s in batch)


def noisy(text: Column, translation: Column) -> Column:
    """Segments not worth refining: many marks, a run of eight equal characters, or a translation far longer than its text."""
    src, tgt = (X.strip(F.coalesce(c, F.lit(""))) for c in (text, translation))
    both = F.concat(src, tgt)
    marks = F.length(both) - F.length(F.translate(both, NOISE, ""))
    ls, lt = F.length(src), F.length(tgt)
    ratio = F.when(ls > 0, lt / F.greatest(ls, F.lit(1))).otherwise(1.0)
    flags = (marks / F.greatest(F.length(both), F.lit(1)) > 0.18) | F.rlike(both, F.lit(r"(?s)(.)\1{7,}")) | ((ls <= 60) & (lt >= 220)) | ((ratio >= 5.0) & (lt >= 180))
    return (both != "") & flags


def longest_run(x: Column) -> Column:
    runs = F.regexp_extract_all(x, F.lit(r"(?s)((.)\2*)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def without_fence(content: Column) -> Column:
    """A code fence around the whole answer goes."""
    s = X.strip(content)
    return F.when(F.startswith(s, F.lit("```")), X.strip(F.regexp_replace(F.regexp_replace(s, r"\A```[^\n]*(?:\n|\z)", ""), r"(?:\n|\A)```[^\n]*\z", ""))).otherwise(s)


def marked_parts(content: Column) -> Column:
    """map<id, text> of an answer in the refining protocol; lines are joined, empty parts dropped, of one id the last part stays."""
    pattern = r"(?s)REFINE::\s*(\d+)::(.*?)(?=REFINE::\s*\d+::|\z)"
    ids, parts = (F.regexp_extract_all(content, F.lit(pattern), F.lit(k)) for k in (1, 2))
    joined = F.transform(parts, lambda p: F.array_join(F.filter(F.transform(X.lines_of(p), X.strip), lambda s: s != ""), " "))
    rows = F.filter(F.arrays_zip(ids.alias("k"), joined.alias("v")), lambda r: r["v"] != "")
    last = F.filter(F.transform(rows, lambda r, i: F.struct(r["k"].alias("k"), r["v"].alias("v"), i.alias("i"))), lambda r: ~F.exists(F.slice(rows, r["i"] + 2, F.size(rows)), lambda o: o["k"] == r["k"]))
    return F.map_from_entries(F.transform(last, lambda r: F.struct(r["k"], r["v"])))


def with_checkpoint(segments: DataFrame, checkpoint: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Segments that a checkpoint (key, id, translation) covers, with their translation, and those that it doesn't. Ids match as text; null ids
    and empty translations cover nothing."""
    known = checkpoint.where(F.col("id").isNotNull() & (F.coalesce("translation", F.lit("")) != "")).select(F.col(key).alias("_k"), F.col("id").cast("string").alias("_i"), "translation").dropDuplicates(["_k", "_i"])
    on = (F.col(key) == F.col("_k")) & (F.col("id").cast("string") == F.col("_i"))
    return segments.join(known, on).drop("_k", "_i"), segments.join(known, on, "left_anti")


def with_known(segments: DataFrame, key: str, checkpoint: DataFrame | None) -> DataFrame:
    """segments with known, what a checkpoint (key, id, translation) has for them; null where it has nothing, and without a checkpoint."""
    if checkpoint is None:
        return segments.withColumn("known", F.lit(None).cast("string"))
    known = checkpoint.where(F.col("id").isNotNull()).select(F.col(key), F.col("id").cast("string").alias("_i"), F.col("translation").alias("known")).dropDuplicates([key, "_i"])
    return segments.withColumn("_i", F.col("id").cast("string")).join(known, [key, "_i"], "left").drop("_i")


def refined_merge(base: DataFrame, refined: DataFrame, keys: list[str]) -> DataFrame:
    """base with refined translations where there are any that aren't blank; adds missing and changed."""
    r = refined.select(*keys, F.col("refined"), F.lit(True).alias("_there"))
    new = F.coalesce(F.nullif(X.strip(F.col("refined")), F.lit("")), F.col("translation"), F.lit(""))
    out = base.join(r, keys, "left").withColumn("_new", new)
    return out.select(*[c for c in base.columns if c != "translation"], F.col("_new").alias("translation"), F.col("_there").isNull().alias("missing"), (F.col("_new") != F.coalesce("translation", F.lit(""))).alias("changed"))


def failure_status(message: Column) -> Column:
    m = F.lower(message)
    return F.when(F.contains(m, F.lit("not ready within")), "not_ready").when(F.contains(m, F.lit("timed out")) | F.contains(m, F.lit("timeout")), "timeout").otherwise("failed")


def retried(call: Callable, attempts: int, pauses=PAUSES, sleep=time.sleep):
    """The call's result; failures but the last are followed by a pause."""
    for i in range(max(1, attempts)):
        try:
            return call()
        except Exception:
            if i + 1 >= max(1, attempts):
                raise
            sleep(pauses[min(i, len(pauses) - 1)])


def _groups(items, size, budget):
    group, used = [], 0
    for x in items:
        n = size(x)
        if group and used + n > budget:
            yield group
            group, used = [], 0
        group.append(x)
        used += n
    if group:
        yield group


def _translated(rows: list[dict], translator: Translator, source: str, target: str, budget: int, attempts: int) -> None:
    """Sets translations. An id that an earlier batch (or the checkpoint) has translated is not sent again."""
    known = {str(r["id"]): r["known"] for r in rows if r["known"] and r["id"] is not None}
    for group in _groups(rows, lambda r: len((r["text"] or "").strip()), max(1, budget)):
        for r in group:
            r["translation"] = known.get(str(r["id"]))
        pending = [r for r in group if not r["translation"]]
        if not pending:
            continue
        joined = f"\n{SEPARATOR}\n".join((r["text"] or "").strip() for r in pending)
        parts = retried(lambda joined=joined: translator(joined, source, target), attempts).split(SEPARATOR)
        if len(parts) != len(pending):
            raise RuntimeError("the number of translated segments differs from that of the batch")
        for r, part in zip(pending, parts, strict=True):
            r["translation"] = known[str(r["id"])] = part.strip()


def _parse(answer: str) -> dict[str, str]:
    import re

    lines = answer.strip().splitlines()
    if lines and lines[0].startswith("```"):
        lines = lines[1:-1] if len(lines) > 1 and lines[-1].startswith("```") else lines[1:]
    parts = re.split(r"REFINE::\s*(\d+)::", "\n".join(lines))
    found = ((k, " ".join(s.strip() for s in v.splitlines() if s.strip())) for k, v in zip(parts[1::2], parts[2::2], strict=True))
    return {k: v for k, v in found if v}


def _refined(rows: list[dict], refiner: Refiner, budget: int, attempts: int) -> dict:
    status = {"refine_status": "no_change", "refine_error": None, "skipped_noisy": sum(r["noisy"] for r in rows), "partial_missing": 0, "chunk_size": 0}
    changes: list[tuple[dict, str]] = []
    try:
        for group in _groups([r for r in rows if not r["noisy"]], lambda r: len((r["text"] or "").strip()) + len((r["translation"] or "").strip()), max(1, budget)):
            status["chunk_size"] = max(status["chunk_size"], len(group))

            def ask(group=group):
                found = _parse(refiner(group))
                for r in group:
                    if str(r["id"]) not in found:
                        found |= {k: v for k, v in _parse(refiner([r])).items() if k == str(r["id"])}
                return found

            found = retried(ask, attempts, pauses=(0,))
            for r in group:
                status["partial_missing"] += str(r["id"]) not in found
                changes.append((r, found.get(str(r["id"]), "").strip() or (r["translation"] or "")))
    except Exception as e:  # noqa: BLE001  any failure leaves the base translation
        said = str(e)
        low = said.lower()
        status |= {"refine_error": said, "refine_status": "not_ready" if "not ready within" in low else "timeout" if isinstance(e, TimeoutError) or "timed out" in low or "timeout" in low else "failed"}
        return status
    if any(new != (r["translation"] or "") for r, new in changes):
        status["refine_status"] = "applied"
    for r, new in changes:
        r["translation"] = new
    return status


TRANSLATED = "id long, start double, end double, text string, translation string"
STATUS = "refine_status string, refine_error string, refine_skipped_noisy int, refine_partial_missing int, refine_chunk_size_used int"


def translate_documents(
    segments: DataFrame, key: str, translator: Translator = offline_translator, refiner: Refiner | None = None, checkpoint: DataFrame | None = None,
    source: str = "auto", target: str = "zh", budget: int = BASE_BUDGET, refine_budget: int = REFINE_BUDGET, attempts: int = 2, refine_attempts: int = 1, streams: int | None = None,
) -> DataFrame:
    """One row for each segment, by id (missing ids as 0), with its translation, and the document's status of refinement on each row.

    segments: key, id, text, and start and end if there are times. checkpoint: key, id, translation of what is done already; or segments have it in
    a column known, see with_known(). streams: at most so many tasks translate at once, so that adapters.paced() can share a pace among them.
    """
    has = segments.columns
    rows = segments.select(key, "id", *(F.col(c).cast("double") if c in has else F.lit(None).cast("double").alias(c) for c in ("start", "end")), "text", *(c for c in ("pos", "known") if c in has))
    if "pos" not in has:
        rows = rows.withColumn("pos", F.col("id"))
    if checkpoint is not None or "known" not in has:
        rows = with_known(rows.drop("known"), key, checkpoint)
    key_type = dict(segments.dtypes)[key]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held = object(), []

        def done():
            _translated(held, translator, source, target, budget, attempts)
            status = {"refine_status": "not_requested", "refine_error": None, "skipped_noisy": 0, "partial_missing": 0, "chunk_size": 0}
            if refiner is not None and held:
                frame = pd.DataFrame(held)
                for r, flag in zip(held, _noisy_rows(frame), strict=True):
                    r["noisy"] = flag
                status = _refined(held, refiner, refine_budget, refine_attempts)
            out = pd.DataFrame(sorted(held, key=lambda r: r["id"] or 0))[[key, "id", "start", "end", "text", "translation"]]
            return out.assign(refine_status=status["refine_status"], refine_error=status["refine_error"], refine_skipped_noisy=status["skipped_noisy"], refine_partial_missing=status["partial_missing"], refine_chunk_size_used=status["chunk_size"])

        for frame in frames:
            for r in frame.astype(object).where(frame.notna(), None).to_dict("records"):
                if r[key] != current:
                    if held:
                        yield done()
                    current, held = r[key], []
                held.append(r)
        if held:
            yield done()

    dealt = (rows.repartition(streams, key) if streams else rows.repartition(key)).sortWithinPartitions(key, "pos")
    return dealt.mapInPandas(run, f"{key} {key_type}, {TRANSLATED}, {STATUS}")


def _noisy_rows(frame: pd.DataFrame) -> list[bool]:
    """noisy() for rows that are in Python already."""
    import re

    out = []
    for src, tgt in zip(frame["text"], frame["translation"], strict=True):
        src, tgt = (src or "").strip(), (tgt or "").strip()
        both = src + tgt
        many = sum(map(both.count, NOISE)) > 0.18 * max(1, len(both))
        wide = len(src) <= 60 and len(tgt) >= 220 or len(tgt) >= 180 and bool(src) and len(tgt) >= 5 * len(src)
        out.append(bool(both) and (many or wide or re.search(r"(?s)(.)\1{7}", both) is not None))
    return out
