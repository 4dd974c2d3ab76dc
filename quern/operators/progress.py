"""Analytics over training logs: matches with their context, the latest record, the median baseline, estimates and risk."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import scalars as S
from quern.operators.running import running

#: What a log's lines hold, and the bytes around a match that belong to it; fixed values.
STEP = rb"steps:\s*[^\r\n]{0,240}?(\d+)/(\d+)[^\r\n]{0,240}?avr_loss=([0-9.]+)"
NEARBY = {"sec_per_step": rb"(\d+(?:\.\d+)?)s/it", "runtime": rb"_runtime[^\x00-\x1f]{0,8}(\d+(?:\.\d+)?)", "ts": rb"_timestamp[^\x00-\x1f]{0,8}(\d+(?:\.\d+)?)"}
AROUND = 256
MATCHES = "path string, nth int, step long, total long, loss double, sec_per_step double, runtime double, ts double"


def log_matches(files: DataFrame) -> DataFrame:
    """A row for each step line of each file (path, content as bytes). Offsets of matches are needed for their context, which no built-in gives."""

    def rows(path: str, data: bytes):
        for n, m in enumerate(re.finditer(STEP, data)):
            context = data[max(0, m.start() - AROUND) : m.end() + AROUND]
            near = {k: re.findall(p, context) for k, p in NEARBY.items()}
            yield path, n, int(m[1]), int(m[2]), float(m[3]), *(float(v[-1]) if v else None for v in near.values())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [r for p, d in zip(frame["path"], frame["content"], strict=True) if d is not None for r in rows(p, bytes(d))]
            yield pd.DataFrame(got, columns=["path", "nth", "step", "total", "loss", "sec_per_step", "runtime", "ts"])

    return files.select("path", "content").mapInPandas(run, MATCHES)


def _furthest() -> list[Column]:
    """What orders records from the furthest on; a step or path that is missing comes last."""
    return [F.isnull("step"), -F.col("step"), -F.coalesce("ts", F.lit(0.0)), -F.coalesce("runtime", F.lit(0.0)), F.isnull("path"), F.col("path")]


def latest_record(matches: DataFrame, *keys: str) -> DataFrame:
    """Of each key: the last match of the file that is furthest by step, time and runtime; of equal ones the first by path."""
    last = matches.groupBy(*keys, "path").agg(F.max_by(F.struct("step", "total", "loss", "sec_per_step", "runtime", "ts"), "nth").alias("r")).select(*keys, "path", "r.*")
    rank = F.struct(*_furthest())
    return last.groupBy(*keys).agg(F.min_by(F.struct("path", "step", "total", "loss", "sec_per_step", "runtime", "ts"), rank).alias("r")).select(*keys, "r.*")


def median_baseline(matches: DataFrame, *keys: str, low: int = 10, high: int = 60) -> DataFrame:
    """Of each key: the exact median of seconds per step within the window of steps; where they are missing, runtime by step stands in."""
    value = F.coalesce("sec_per_step", F.when((F.col("runtime") != 0) & (F.col("step") != 0), F.col("runtime") / F.col("step")))
    return matches.withColumn("v", value).where(F.col("step").between(low, high)).groupBy(*keys).agg(F.median("v").cast("double").alias("baseline"))


def exact_medians(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, median of the values that aren't null: the middle one, or the mean of the two in the middle. Values are sorted over ranges and numbered, so no task
    holds all values of a key, however many it has; a key without values has none."""
    placed = running(rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v")), keys, [F.col("_v")], {}, "_pos")
    sizes = placed.groupBy(*keys).agg(F.max("_pos").alias("_last"))
    on = F.lit(True)
    for i, k in enumerate(keys):
        sizes, on = sizes.withColumnRenamed(k, f"_k{i}"), on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    both = placed.join(sizes, on) if keys else placed.crossJoin(F.broadcast(sizes))  # one row
    middle = both.where((F.col("_pos") == F.floor(F.col("_last") / 2)) | (F.col("_pos") == F.ceil(F.col("_last") / 2)))
    return middle.groupBy(*keys).agg(((F.min("_v") + F.max("_v")) / 2).alias("median")).where("median IS NOT NULL")


def spread_baseline(matches: DataFrame, *keys: str, low: int = 10, high: int = 60) -> DataFrame:
    """median_baseline() for keys with more values than a task can hold."""
    value = F.coalesce("sec_per_step", F.when((F.col("runtime") != 0) & (F.col("step") != 0), F.col("runtime") / F.col("step")))
    rows = matches.where(F.col("step").between(low, high)).select(*keys, value.alias("_value"))
    return exact_medians(rows, list(keys), "_value").withColumnRenamed("median", "baseline")


def latest_and_baseline(matches: DataFrame, *keys: str, low: int = 10, high: int = 60) -> DataFrame:
    """latest_record() and median_baseline() in one row for each key, from one pass over the matches."""
    value = F.coalesce("sec_per_step", F.when((F.col("runtime") != 0) & (F.col("step") != 0), F.col("runtime") / F.col("step")))
    fields = ("path", "step", "total", "loss", "sec_per_step", "runtime", "ts")
    # Of the last matches of all files the furthest counts; whether a match is its file's last shows from the file's greatest place alone.
    last = F.max("nth").over(Window.partitionBy(*keys, "path"))
    rank = F.struct(*_furthest())
    rows = matches.withColumns({"_v": F.when(F.col("step").between(low, high), value), "_rank": F.when(F.col("nth") == last, rank)})
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*fields), "_rank").alias("r"), F.median("_v").cast("double").alias("baseline")).where("r IS NOT NULL").select(*keys, "r.*", "baseline")


def progress(records: DataFrame) -> DataFrame:
    """Adds percent, seconds_per_step, eta_seconds and status to records with step, total, sec_per_step and runtime."""
    per = F.coalesce("sec_per_step", F.when((F.col("runtime") != 0) & (F.col("step") != 0), F.col("runtime") / F.col("step")))
    out = records.withColumn("seconds_per_step", per)
    return out.withColumns({
        "percent": F.when(F.col("total") != 0, F.col("step") / F.col("total") * 100).otherwise(0.0),
        "eta_seconds": F.when(F.col("total") >= F.col("step"), (F.col("total") - F.col("step")) * F.col("seconds_per_step")),
        "status": F.when(F.col("step") < F.col("total"), "running").otherwise("finished"),
    })


def latest_folder(files: DataFrame, containing: bytes | None = None) -> DataFrame:
    """The folder changed last; with containing, of those with a file that holds these bytes. files: folder, changed, content."""
    if containing is not None:
        files = files.where(F.contains(F.col("content"), F.lit(containing)))
    return files.groupBy().agg(F.max_by("folder", F.struct("changed", "folder")).alias("folder"))


def adapter_memory(counters: DataFrame) -> DataFrame:
    """shared_used_mb and shared_limit_mb from counters (path, value): the largest shared or non-local usage, and the largest number in
    parentheses on such a path."""
    hit = F.contains("path", F.lit("Shared Usage")) | F.contains("path", F.lit("Non Local Usage"))
    limit = F.expr(r"try_cast(nullif(regexp_extract(path, '\\((\\d+)\\)', 1), '') AS BIGINT)")
    return counters.where(hit).agg(F.max(S.megabytes(F.col("value"))).alias("shared_used_mb"), F.max(limit).alias("shared_limit_mb"))


def process_memory(counters: DataFrame, pid: int) -> DataFrame:
    """Largest dedicated and shared megabytes of one process. "Non Local Usage" holds "Local Usage", so it counts as dedicated."""
    local = F.contains("path", F.lit("Dedicated Usage")) | F.contains("path", F.lit("Local Usage"))
    shared = ~local & F.contains("path", F.lit("Shared Usage"))
    own = counters.where(F.contains(F.lower("path"), F.lit(f"pid_{pid}_"))).withColumn("mb", S.megabytes(F.col("value")))
    return own.agg(F.max(F.when(local, F.col("mb"))).alias("dedicated_train_mb"), F.max(F.when(shared, F.col("mb"))).alias("shared_train_mb"))


def device_line(line: Column) -> Column:
    """Six fields of a device query's line, null where there are fewer."""
    parts = F.transform(F.split(line, ","), lambda p: F.trim(p))  # bare, trim would take the place for what to cut off
    num = lambda i: F.get(parts, F.lit(i)).try_cast("int")
    names = ["dedicated_total_mb", "dedicated_used_mb", "dedicated_free_mb", "gpu_util_percent", "temperature_c"]
    return F.when(F.size(parts) >= 6, F.struct(F.get(parts, F.lit(0)).alias("gpu_name"), *(num(i + 1).alias(n) for i, n in enumerate(names))))


#: Programs whose processes count as training; fixed values.
TRAINERS = ["train_network.py", "sdxl_train_network.py", "flux_train_network.py"]


def trainers(processes: DataFrame, names: list[str] = TRAINERS) -> DataFrame:
    """The newest process (largest pid) whose command line names one of the programs."""
    hit = F.lit(False)
    for n in names:
        hit = hit | F.contains(F.lower("command"), F.lit(n.lower()))
    return processes.where(hit).agg(F.max("pid").alias("pid"))


def with_risk(df: DataFrame) -> DataFrame:
    """Adds speed_ratio, risk and risk_reason from seconds_per_step, baseline, shared_train_mb, shared_used_mb and dedicated_free_mb."""
    ratio = F.when((F.col("baseline") > 0) & (F.col("seconds_per_step") != 0), F.col("seconds_per_step") / F.col("baseline"))
    out = df.withColumn("speed_ratio", ratio)
    band, reason = S.risk(F.coalesce("shared_train_mb", "shared_used_mb"), F.col("dedicated_free_mb"), F.col("speed_ratio"))
    return out.withColumns({"risk": band, "risk_reason": reason})


def report(df: DataFrame) -> DataFrame:
    """Rounded figures as JSON text."""
    rounded = {"percent": 2, "seconds_per_step": 3, "baseline": 3, "speed_ratio": 3, "eta_seconds": 1}
    fields = [(F.bround(F.col(c), rounded[c]) if c in rounded else F.col(c)).alias("baseline_seconds_per_step" if c == "baseline" else c) for c in df.columns]
    return df.select(F.to_json(F.struct(*fields, S.eta(F.col("eta_seconds")).alias("eta_human")), {"ignoreNullFields": "false"}).alias("report"))
