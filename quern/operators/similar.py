"""Similar keys: those within two edits of each other, joined into groups.

Two strings within two edits share a string that two deletions from each, or fewer, lead to. So every key is exploded into its deletions, keys meet at a
deletion, and edits are counted only where meeting doesn't prove enough: two keys that lost one letter each, or a key and what it lost two letters to, are
within two edits as they are, and a star ties them. A long key has too many deletions; cut into three pieces, one of them is whole in any string within two
edits, at most two places off, so long keys meet at pieces.
"""

from __future__ import annotations

import itertools

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.components import components

#: Edits within which keys are similar, and the length from which keys meet at pieces.
EDITS, LONG = 2, 40


def _deletions(key: str) -> list[tuple[str, int]]:
    least: dict[str, int] = {}
    for lost in range(EDITS + 1):
        for gone in itertools.combinations(range(len(key)), lost):
            parts, at = [], 0
            for g in gone:
                parts.append(key[at:g])
                at = g + 1
            least.setdefault("".join([*parts, key[at:]]), lost)
    return list(least.items())


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("d", T.StringType()), T.StructField("lost", T.IntegerType())])))
def deletions(x: pd.Series) -> pd.Series:
    """What up to two deletions leave of a key, each with the fewest that lead to it."""
    return x.map(_deletions)


def _short_links(keys: DataFrame) -> DataFrame:
    """u, v: enough links for the groups of keys that meet at deletions."""
    at = keys.select("key", F.explode(deletions("key")).alias("x")).select("key", "x.d", "x.lost")
    centre = at.groupBy("d").agg(F.min(F.when(F.col("lost") == 0, F.col("key"))).alias("whole"), F.min(F.when(F.col("lost") <= 1, F.col("key"))).alias("least"), F.count("*").alias("n"), F.max("lost").alias("most")).where("n > 1")
    met = at.join(centre, "d")
    stars = met.where("whole IS NOT NULL").select(F.col("key").alias("u"), F.col("whole").alias("v"))
    stars = stars.unionByName(met.where("whole IS NULL AND lost <= 1").select(F.col("key").alias("u"), F.col("least").alias("v")))
    open_ = met.where("whole IS NULL AND most = 2").select("d", "key", "lost")
    a, b = open_.where("lost = 2").select("d", F.col("key").alias("u")), open_.select("d", F.col("key").alias("v"), "lost")
    pairs = a.join(b, "d").where("lost < 2 OR u < v").select("u", "v").distinct()
    return stars.where("u <> v").unionByName(pairs.where(F.levenshtein("u", "v", EDITS) >= 0))


def _cut(length, piece: int):
    """Where a piece of a key of some length begins, from 1 on, and how long it is."""
    n = EDITS + 1
    begin = F.floor(length * piece / n).cast("int")
    return begin + 1, F.floor(length * (piece + 1) / n).cast("int") - begin


def _long_links(keys: DataFrame) -> DataFrame:
    """u, v: the similar pairs of long keys, u being at least as long as v."""
    own, asked = [], []
    for piece in range(EDITS + 1):
        begin, size = _cut(F.length("key"), piece)
        own.append(F.struct(F.length("key").alias("length"), F.lit(piece).alias("piece"), F.substr("key", begin, size).alias("s")))
        for shorter in range(EDITS + 1):
            begin, size = _cut(F.length("key") - shorter, piece)
            for off in range(-EDITS, EDITS + 1):
                asked.append(F.when(begin + off >= 1, F.struct((F.length("key") - shorter).alias("length"), F.lit(piece).alias("piece"), F.substr("key", begin + off, size).alias("s"))))
    mine = keys.select(F.col("key").alias("v"), F.explode(F.array(*own)).alias("x")).select("v", "x.*")
    theirs = keys.select(F.col("key").alias("u"), F.explode(F.array_distinct(F.array_compact(F.array(*asked)))).alias("x")).select("u", "x.*")
    pairs = theirs.join(mine, ["length", "piece", "s"]).where("u <> v").select("u", "v").distinct()
    return pairs.where(F.levenshtein("u", "v", EDITS) >= 0)


def groups(df: DataFrame, key: str, long: int = LONG) -> DataFrame:
    """key, root of each different key of df: the least key that chains of similar ones lead to. Null keys are left out."""
    keys = df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key")).distinct()
    links = _short_links(keys.where(F.length("key") <= long)).unionByName(_long_links(keys.where(F.length("key") > long - EDITS)))
    tied = components(links.distinct(), "similar")
    return keys.join(tied, F.col("key") == F.col("node"), "left").select("key", F.coalesce("root", "key").alias("root"))


def merged(corrections: DataFrame, key: str, ts: str = "ts", long: int = LONG) -> DataFrame:
    """Similar corrections as one line: root, the spelling that is most frequent (of equal ones the least), how often they were made in how many spellings,
    from when to when, and a summary."""
    per = corrections.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n"), F.min(ts).cast("date").alias("first"), F.max(ts).cast("date").alias("last"))
    best = F.min_by("key", F.struct(-F.col("n"), F.col("key"))).alias("spelling")
    out = per.join(groups(per, "key", long), "key").groupBy("root").agg(best, F.sum("n").alias("n"), F.count("*").alias("spellings"), F.min("first").alias("first"), F.max("last").alias("last"))
    return out.withColumn("summary", F.concat("spelling", F.lit(" (confirmed "), F.col("n").cast("string"), F.lit("x, "), F.col("first").cast("string"), F.lit(" to "), F.col("last").cast("string"), F.lit(")")))
