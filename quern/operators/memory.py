"""Lifecycle of remembered patterns over their events: promotion, decay, stages, precedence, conflicts, figures. These follow rules given in
prose only. Events: key, ts, and, where needed, level and value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Uses within days that promote; days unused until a pattern is warm, and cold; levels from the least specific on; fixed values.
USES, WITHIN_DAYS, WARM_DAYS, COLD_DAYS = 3, 7, 30, 90
LEVELS = ["global", "domain", "project"]


def promotions(events: DataFrame, *keys: str, ts: str = "ts") -> DataFrame:
    """Adds uses (of the key in the seven days up to the event, both ends included) and hot."""
    w = f"count(*) OVER (PARTITION BY {', '.join(keys)} ORDER BY {ts} RANGE BETWEEN INTERVAL {WITHIN_DAYS} DAYS PRECEDING AND CURRENT ROW)"
    return events.withColumn("uses", F.expr(w)).withColumn("hot", F.col("uses") >= USES)


def decay(events: DataFrame, *keys: str, now: Column, ts: str = "ts") -> DataFrame:
    """Of each key: when it was last used, days since, and its tier."""
    out = events.groupBy(*keys).agg(F.max(ts).alias("last_used")).withColumn("idle_days", F.datediff(now, "last_used").cast("long"))
    return out.withColumn("tier", F.when(F.col("idle_days") > COLD_DAYS, "COLD").when(F.col("idle_days") > WARM_DAYS, "WARM").otherwise("HOT"))


def stages(events: DataFrame, *keys: str, order: list[str]) -> DataFrame:
    """Adds nth (running number within the key) and the stage that it reaches."""
    out = events.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    return out.withColumn("stage", F.when(F.col("nth") == 1, "tentative").when(F.col("nth") == 2, "emerging").otherwise("pending"))


def level_rank(level: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, LEVELS)), level)


def precedence(entries: DataFrame, key: str, level: str, ts: str, *rest: str) -> DataFrame:
    """Of each key the entry that wins: the most specific level, then the latest; a full tie is settled by the rest. A struct's maximum keeps
    one row for each key and task before the shuffle."""
    best = F.max(F.struct(level_rank(F.col(level)).alias("_rank"), *(F.col(c) for c in (ts, *rest, level))))
    return entries.groupBy(key).agg(best.alias("b")).select(key, F.col(f"b.{level}"), F.col(f"b.{ts}"), *(F.col(f"b.{c}") for c in rest))


def conflicts(entries: DataFrame, key: str, level: str, value: str) -> DataFrame:
    """Pairs of levels of one key whose values differ. Entries are reduced to distinct level and value first, so that the self-join grows with
    what is said, not with how often. Entries without a level or value, or of an unknown level, take no part."""
    one = entries.where(F.col(level).isin(LEVELS) & F.col(value).isNotNull()).select(key, F.col(level).alias("level"), F.col(value).alias("value"), level_rank(F.col(level)).alias("r")).distinct()
    a, b = (one.select(key, *(F.col(c).alias(f"{c}_{s}") for c in ("level", "value", "r"))) for s in "ab")
    return a.join(b, key).where("r_a < r_b AND value_a <> value_b").drop("r_a", "r_b")


def tier_stats(entries: DataFrame, tier: str, ts: str, now: Column, days: int = 7) -> DataFrame:
    recent = F.col(ts) >= now - F.expr(f"INTERVAL {days} DAYS")
    return entries.groupBy(tier).agg(F.count("*").alias("entries"), F.count_if(recent).alias("recent"))


def last_n(events: DataFrame, n: int, *order: Column) -> DataFrame:
    return events.orderBy(*order).limit(n)


def merged(corrections: DataFrame, *keys: str, ts: str = "ts") -> DataFrame:
    """Similar corrections as one line: how often, and from when to when."""
    out = corrections.groupBy(*keys).agg(F.count("*").alias("n"), F.min(ts).cast("date").alias("first"), F.max(ts).cast("date").alias("last"))
    return out.withColumn("summary", F.concat(F.lit("confirmed "), F.col("n").cast("string"), F.lit("x, "), F.col("first").cast("string"), F.lit(" to "), F.col("last").cast("string")))


def at_risk(usage: DataFrame, key: str, n: int = 10, share: float = 0.5) -> DataFrame:
    """The n keys of least usage below a share of the average. usage: key, uses. The average is one row, broadcast as such."""
    mean = usage.agg(F.avg("uses").alias("mean"))
    below = usage.crossJoin(F.broadcast(mean)).where(F.col("uses") < share * F.col("mean"))
    return below.orderBy("uses", key).limit(n)


def compared(baseline: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """key, status: added, removed, changed or same, from a full outer comparison."""
    a, b = baseline.select(key, F.col(value).alias("_a"), F.lit(1).alias("_ia")), current.select(key, F.col(value).alias("_b"), F.lit(1).alias("_ib"))
    status = F.when(F.col("_ia").isNull(), "added").when(F.col("_ib").isNull(), "removed").when(F.col("_a").eqNullSafe(F.col("_b")), "same").otherwise("changed")
    return a.join(b, key, "full").select(key, status.alias("status"))


def changed_since(files: DataFrame, mark: Column, state_path: str, changed: str = "changed", path: str = "path") -> DataFrame:
    """Files changed after the mark, but for the one that keeps the mark."""
    return files.where((F.col(changed) > mark) & (F.col(path) != state_path))


def by_time_cost(tasks: DataFrame, minutes: str, times: str) -> DataFrame:
    """Tasks with the hours a month that they take, those that take most first."""
    return tasks.withColumn("hours", F.col(minutes) * F.col(times) / 60).orderBy(F.desc("hours"), *tasks.columns)


def best_near(frames: DataFrame, key: str, at: str, target: Column, within: Column, score: str, *rest: str) -> DataFrame:
    """Of each key, among what lies within a span around the target time, the row of the best score; of equal ones the nearest, then the first.
    A struct's maximum keeps one row for each key and task before the shuffle."""
    away = F.abs(F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(target.cast("timestamp")))
    near = frames.withColumn("_away", away).where(F.col("_away") <= within)
    best = F.max_by(F.struct(score, at, *rest), F.struct(F.col(score), -F.col("_away"), -F.unix_micros(F.col(at).cast("timestamp")), *(-F.col(c) for c in rest)))
    return near.groupBy(key).agg(best.alias("b")).select(key, "b.*")


def list_with_details(items: DataFrame, details: DataFrame, key: str, **sums: str) -> DataFrame:
    """Each item of a list with the number of its details and sums of their columns (name=column); 0 where there are none."""
    per = details.groupBy(key).agg(F.count("*").alias("details"), *(F.sum(c).alias(n) for n, c in sums.items()))
    return items.join(per, key, "left").na.fill(0, ["details", *sums])
