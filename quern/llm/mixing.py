"""Mixing sources to target weights by a curriculum whose weights vary over the training.

Each source has a weight schedule over training time, from 0 to 1: straight lines between knots. The schedule's integral is the source's weight in the
whole mix; its running integral, scaled to the source's target, is the demand for its words up to a time. The documents of a source follow each
other in a fixed random order, again and again; the demand, inverted at a document's first word, is the time at which it is due, its position.
Documents sorted by position, over ranges, are the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import table, written
from quern.operators.running import running

#: What counts as a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Times that a document may be taken.
EPOCHS = 3
#: Rows of sources up to which they are broadcast; more are joined by shuffling.
BROADCAST_ROWS = 1 << 16
#: Weights are added up in millionths.
UNIT = 1_000_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def schedule(knots: list[tuple[float, float]]) -> Column:
    """A weight schedule as an array of pieces: its start, weight there, slope, and its integral up to the piece's start and end. knots: (time, weight),
    from time 0 to time 1."""
    if len(knots) < 2 or knots[0][0] != 0 or knots[-1][0] != 1 or any(a[0] >= b[0] for a, b in zip(knots, knots[1:], strict=False)) or any(w < 0 for _, w in knots):
        raise ValueError("a schedule needs rising times from 0 to 1 and weights of 0 or more")
    pieces, area = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        to = area + (w0 + w1) * (t1 - t0) / 2
        pieces.append(F.struct(F.lit(float(t0)).alias("t"), F.lit(float(w0)).alias("w"), F.lit((w1 - w0) / (t1 - t0)).alias("slope"), F.lit(area).alias("a"), F.lit(to).alias("b")))
        area = to
    return F.array(*pieces)


def integral(pieces: Column) -> Column:
    return F.element_at(pieces, -1)["b"]


def time_of(share: Column, pieces: Column) -> Column:
    """The time at which the schedule's running integral has the share (from 0 to 1) of the whole: the inverse of the cumulative demand."""
    y = share * integral(pieces)
    within = F.get(F.filter(pieces, lambda p: (p["a"] <= y) & ((y < p["b"]) | (p["b"] == integral(pieces))) & (p["a"] < p["b"])), F.lit(0))
    rest = y - within["a"]
    return within["t"] + F.when(rest > 0, 2 * rest / (within["w"] + F.sqrt(F.greatest(within["w"] * within["w"] + 2 * within["slope"] * rest, F.lit(0.0))))).otherwise(0.0)


def targets(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """sources (source, source_size, pieces) with target, the words to take of each: the sources share the sum of all sizes by weight; none gets
    more than epochs times its size, and what is above goes to the others by weight, until none is above.

    The shares rise together until a source is full, so the sources fill in the order of size by weight; of each place in that order, the running
    sums of what is full tell the level of the others. The first place whose own source isn't full at that level ends it.
    """
    weighed = sources.withColumn("_w", F.round(integral(F.col("pieces")) * UNIT).cast("long")).withColumn("_cap", F.col("source_size") * epochs)
    full_at = F.when(F.col("_w") > 0, F.col("_cap") / F.col("_w")).otherwise(0.0)
    rows = weighed.withColumn("_full_at", full_at).withColumn("_cap", F.when(F.col("_w") > 0, F.col("_cap")).otherwise(F.lit(0).cast("long")))
    placed = running(rows, [], [F.col("_full_at"), F.col("source").isNull(), F.col("source")], {"_caps": F.col("_cap"), "_ws": F.col("_w")}, "_place")
    whole = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("_all"), F.coalesce(F.sum("_w"), F.lit(0)).alias("_wall"))
    level = placed.crossJoin(F.broadcast(whole)).withColumns({"_rest": F.col("_all") - F.col("_caps"), "_wrest": F.col("_wall") - F.col("_ws")})  # one row
    level = level.where((F.col("_w") > 0) & (F.try_divide("_rest", "_wrest") <= F.col("_full_at")))
    one = level.agg(F.min_by(F.struct("_place", "_rest", "_wrest"), "_place").alias("_level"))
    target = F.when(F.col("_place") >= F.col("_level._place"), F.col("_level._rest") * (F.col("_w") / F.col("_level._wrest"))).otherwise(F.col("_cap").cast("double"))
    return placed.crossJoin(F.broadcast(one)).select("source", "source_size", "pieces", target.alias("target"))  # one row


def curriculum(docs: DataFrame, schedules: DataFrame | None = None, by_rank: list[Column] | None = None, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and plays of each document: array<struct<pass, words, position>>, the times that the mix takes it.

    schedules: source, pieces (see schedule()); a source without one gets nothing. Or by_rank: the schedules of the sources in the order of their
    code points, null last, over and over. The documents of a source are taken in the order of a hash of their id, whole passes over all of them
    and then a part, whose last document is cut where the target is met; so the words taken of a source differ from its target by less than one.

    Null texts and texts without words have size 0 and are never taken. A null source is a source. Rows that repeat are rows of their own; ids that
    repeat, or are null, follow each other by size. Other columns of docs, whatever their names, are left out. No documents give no rows.
    """
    sized = written(docs.select("doc_id", F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size")), "sized")
    sources = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    if by_rank is not None:
        ranked = running(sources, [], [F.col("source").isNull(), F.col("source")], {}, "_rank")
        sources = ranked.withColumn("pieces", F.element_at(F.array(*by_rank), (F.col("_rank") % len(by_rank) + 1).cast("int"))).drop("_rank")
    else:
        s = schedules.select(F.col("source").cast("string").alias("_source"), "pieces")
        sources = sources.join(s, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
        sources = sources.withColumn("pieces", F.coalesce("pieces", schedule([(0, 0), (1, 0)])))
    sources = written(targets(sources, epochs), "targets")
    placed = running(sized, ["source"], [F.md5(F.col("doc_id").cast("string")), F.col("doc_id"), F.col("size")], {"_before": F.col("size")})
    mine = sources.withColumnRenamed("source", "_source")
    mine = F.broadcast(mine) if mine.count() <= BROADCAST_ROWS else mine
    rows = placed.join(mine, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    demand = F.round("target").cast("long")

    def play(p: Column) -> Column:
        start = p * F.col("source_size") + F.col("_before")
        share = F.when(start < F.col("target"), start / F.col("target")).otherwise(1.0)
        return F.struct(p.cast("int").alias("pass"), F.greatest(F.least(F.col("size"), demand - start), F.lit(0).cast("long")).alias("words"), time_of(share, F.col("pieces")).alias("position"))

    plays = F.filter(F.transform(F.array(*(F.lit(p).cast("long") for p in range(epochs))), play), lambda p: p["words"] > 0)
    taken = F.aggregate("plays", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    return rows.withColumn("plays", plays).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "plays")


def training_order(mix: DataFrame) -> DataFrame:
    """doc_id, source, pass, words and position of each time that a document is taken, sorted over ranges by position; equal positions by source and
    id, so that reruns agree."""
    each = mix.select("doc_id", "source", F.explode("plays").alias("p")).select("doc_id", "source", "p.pass", "p.words", "p.position")
    return each.orderBy("position", "source", "doc_id", "pass", "words")


def fading(weights: tuple[int, ...] = (5, 2, 1), change: float = 0.5) -> list[Column]:
    """Schedules whose integrals are the weights: the first source's weight falls over the training, the last one's rises."""
    n = max(1, len(weights) - 1)
    tilts = [change * (1 - 2 * i / n) for i in range(len(weights))]
    return [schedule([(0, w * (1 + a)), (1, w * (1 - a))]) for w, a in zip(weights, tilts, strict=True)]


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents by weights 5, 2, 1 of the sources, sorted by the position at which they first are due (null: never)."""
    mix = curriculum(table(spark, sf_dir, "documents"), by_rank=fading())
    first = F.round(F.get("plays", F.lit(0))["position"], 6)
    return mix.select("doc_id", "size", "source_size", "target", "taken", first.alias("position")).orderBy("position", "doc_id", "size")


OP12_SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(row_number() OVER (ORDER BY source NULLS LAST) - 1 AS BIGINT) % 3 AS k FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][k + 1] AS w, [7.5, 2, 0.5][k + 1]::DOUBLE AS w0, [-5, 0, 1][k + 1]::DOUBLE AS slope FROM s),
r AS (SELECT *, 3 * source_size / w AS full_at, row_number() OVER o AS place, coalesce(sum(3 * source_size) OVER b, 0) AS caps, coalesce(sum(w) OVER b, 0) AS ws, sum(source_size) OVER () AS total, sum(w) OVER () AS wall
 FROM w WINDOW o AS (ORDER BY 3 * source_size / w, source NULLS LAST), b AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT place AS stop, total - caps AS rest, wall - ws AS wrest FROM r WHERE (total - caps) / (wall - ws) <= full_at ORDER BY place LIMIT 1),
g AS (SELECT r.*, CASE WHEN place >= stop THEN CAST(rest AS DOUBLE) * (w / wrest) ELSE CAST(3 * source_size AS DOUBLE) END AS target FROM r, l),
p AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
x AS (SELECT p.*, g.source_size, g.target, g.w, g.w0, g.slope, list_transform([0, 1, 2], lambda e: greatest(0, least(size, CAST(round_even(g.target, 0) AS BIGINT) - e * g.source_size - before))) AS t
 FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source),
y AS (SELECT *, CASE WHEN target > before THEN CAST(before AS DOUBLE) / target ELSE 1 END * w AS y FROM x)
SELECT doc_id, size, source_size, target, CAST(list_sum(t) AS BIGINT) AS taken,
 CASE WHEN t[1] > 0 THEN round(CASE WHEN y > 0 THEN 2 * y / (w0 + sqrt(w0 * w0 + 2 * slope * y)) ELSE 0 END, 6) END AS position FROM y
"""
