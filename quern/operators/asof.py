"""Joins by time: the row last before a time, next after it, or nearest, and the best of those near it.

Both sides are dealt by key and a span of time, so that a key with most rows spreads over as many tasks as it has spans. In a span the two sides are merged in
order; what the spans before hold last is one row for each span, and comes in from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _micros(at: Column) -> Column:
    return F.unix_micros(at.cast("timestamp"))


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, tie: str, span_seconds: int = 86_400, direction: str = "backward", within_seconds: float | None = None) -> DataFrame:
    """The rows of left, each with match, a struct of the right row of its keys that is last at or before its time (backward), first at or after it (forward)
    or nearest (of equally near ones the one before); null where there is none, or none within the given time.

    Of right rows at one time the one of the largest tie counts. Rows of left without time have no match; null keys match null keys. span_seconds: the time
    that one task holds of one key; it changes no result."""
    if direction == "nearest":
        names = [c for c in left.columns]
        both = asof_join(left, right, keys, left_at, right_at, tie, span_seconds, "backward", within_seconds).withColumnRenamed("match", "_before")
        both = asof_join(both, right, keys, left_at, right_at, tie, span_seconds, "forward", within_seconds).withColumnRenamed("match", "_after")
        away = lambda c: F.abs(_micros(F.col(f"{c}.{right_at}")) - _micros(F.col(left_at)))
        later = F.col("_before").isNull() | (away("_after") < away("_before"))
        return both.select(*names, F.when(F.col("_after").isNotNull() & later, F.col("_after")).otherwise(F.col("_before")).alias("match"))
    forward = direction == "forward"
    span = F.floor(F.col("_at") / (span_seconds * 1_000_000)).cast("long")
    kind = right.schema
    one = right.where(F.col(right_at).isNotNull()).groupBy(*keys, _micros(F.col(right_at)).alias("_at")).agg(F.max_by(F.struct(*right.columns), F.struct(tie)).alias("_right"))
    none = F.lit(None).cast(kind)
    lefts = left.select(*keys, _micros(F.col(left_at)).alias("_at"), F.struct(*left.columns).alias("_left"), none.alias("_right"))
    rights = one.select(*keys, "_at", F.lit(None).cast(left.schema).alias("_left"), "_right")
    tagged = lefts.unionByName(rights).withColumns({"_span": span, "_tag": F.when(F.col("_left").isNull(), 0).otherwise(1)})  # at one time right rows come first
    order = [F.desc("_at") if forward else F.asc("_at"), F.asc("_tag")]
    here = Window.partitionBy(*keys, "_span").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = tagged.withColumn("_match", F.last("_right", ignorenulls=True).over(here)).where("_tag = 1")
    # what each span has to hand on: a row for each key and span, of the spans that either side has
    edge = (F.min_by if forward else F.max_by)("_right", F.when(F.col("_tag") == 0, F.col("_at")))
    spans = tagged.groupBy(*keys, "_span").agg(edge.alias("_edge"))
    beyond = Window.partitionBy(*keys).orderBy(F.desc("_span") if forward else F.asc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    handed = spans.withColumn("_beyond", F.last("_edge", ignorenulls=True).over(beyond)).where("_beyond IS NOT NULL").select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_span").alias("_s"), "_beyond")
    on = F.col("_span") == F.col("_s")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = inside.join(handed, on, "left").withColumn("match", F.coalesce("_match", "_beyond"))
    if within_seconds is not None:
        near = F.abs(_micros(F.col(f"match.{right_at}")) - F.col("_at")) <= int(within_seconds * 1_000_000)
        out = out.withColumn("match", F.when(near, F.col("match")))
    return out.select("_left.*", F.when(F.col("_at").isNotNull(), F.col("match")).alias("match"))


def best_near(targets: DataFrame, frames: DataFrame, keys: list[str], target_at: str, frame_at: str, within_seconds: float, score: str, tie: str) -> DataFrame:
    """The rows of targets, each with match, a struct of the frame of its keys with the best score among those within the given time of it: of equal ones the
    nearest, then the earlier one, then that of the least tie; null where there is none.

    Targets and frames meet in spans as long as that time: a target asks in its own span and the two beside it."""
    width = max(1, int(within_seconds * 1_000_000))
    asked = targets.select(*keys, _micros(F.col(target_at)).alias("_at")).distinct()  # targets of one time have one answer
    asked = asked.withColumn("_span", F.explode(F.sequence(F.floor(F.col("_at") / width) - 1, F.floor(F.col("_at") / width) + 1)))
    given = frames.where(F.col(frame_at).isNotNull()).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.floor(_micros(F.col(frame_at)) / width).alias("_s"), _micros(F.col(frame_at)).alias("_frame_at"), F.col(tie).alias("_tie"), F.col(score).alias("_score"), F.struct(*frames.columns).alias("_frame"))
    on = F.col("_span") == F.col("_s")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    away = F.abs(F.col("_frame_at") - F.col("_at"))
    near = asked.join(given, on).where((away <= width) & F.col("_score").isNotNull())
    rank = F.struct(-F.col("_score"), away, F.col("_frame_at"), F.col("_tie"))
    # one frame for each target and task is left before the shuffle
    best = near.groupBy(*keys, F.col("_at").alias("_target")).agg(F.min_by("_frame", rank).alias("match"))
    back = best.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_target", "match")
    same = _micros(F.col(target_at)) == F.col("_target")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return targets.join(back, same, "left").drop("_target", *(f"_k{i}" for i in range(len(keys))))
