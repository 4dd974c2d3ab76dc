"""Hybrid retrieval: cosine and BM25 scores of bounded pools, weighed together. Only the weights and limits are given; the formulas are the
usual ones."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.sources.interim import written

#: Weights, least scores, pool size; fixed values. K1 and B are BM25's usual parameters.
VECTOR, KEYWORD, MIN_SCORE, HARD_MIN_SCORE, POOL, LENGTH_ANCHOR = 0.7, 0.3, 0.25, 0.28, 12, 500
K1, B = 1.2, 0.75


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)


def vector_pool(vectors: DataFrame, query: list[float], key: str, vector: str, n: int = POOL) -> DataFrame:
    """key, score of the n nearest vectors; ties go to the lesser key. A top-n, so each task sends n rows."""
    q = F.array(*map(F.lit, query))
    return vectors.select(key, cosine(F.col(vector), q).alias("score")).orderBy(F.desc("score"), key).limit(n)


def _count(text: Column, term: str) -> Column:
    """How often a word stands in a lower-cased text; texts without its letters aren't searched by pattern."""
    return F.when(F.contains(text, F.lit(term)), F.regexp_count(text, F.lit(rf"\Q{term}\E(?![\p{{L}}\p{{N}}])(?<![\p{{L}}\p{{N}}]\Q{term}\E)"))).otherwise(0)


def counted(texts: DataFrame, terms: list[str], key: str, text: str) -> DataFrame:
    """key, _chars, _n (words) and _t0, _t1 and so on (how often each term stands) of each text, written once: all that statistics and scores need."""
    low = texts.select(key, F.length(text).alias("_chars"), F.lower(text).alias("_low"))
    counts = low.select(key, "_chars", F.regexp_count("_low", F.lit(r"[\p{L}\p{N}]+")).alias("_n"), *(_count(F.col("_low"), t).alias(f"_t{i}") for i, t in enumerate(terms)))
    return written(counts, "counts")


def keyword_pool(texts: DataFrame, terms: list[str], key: str, text: str, n: int = POOL) -> DataFrame:
    """key, score (BM25 of the terms) of the n best texts. Words are counted, not cut out, in one pass; nothing is exploded."""
    return _scored(counted(texts, terms, key, text), terms, key, n)


def _scored(counts: DataFrame, terms: list[str], key: str, n: int) -> DataFrame:
    stats = counts.agg(F.count("*").alias("_docs"), F.avg("_n").alias("_mean"), *(F.count_if(F.col(f"_t{i}") > 0).alias(f"_d{i}") for i in range(len(terms))))
    score = F.lit(0.0)
    for i in range(len(terms)):
        idf = F.log(1 + (F.col("_docs") - F.col(f"_d{i}") + 0.5) / (F.col(f"_d{i}") + 0.5))
        score = score + idf * F.col(f"_t{i}") * (K1 + 1) / (F.col(f"_t{i}") + K1 * (1 - B + B * F.col("_n") / F.col("_mean")))
    held = functools.reduce(Column.__or__, (F.col(f"_t{i}") > 0 for i in range(len(terms))), F.lit(False))
    return counts.where(held).crossJoin(F.broadcast(stats)).select(key, score.alias("score")).where("score > 0").orderBy(F.desc("score"), key).limit(n)


def length_share(chars: Column) -> Column:
    """What a text's length leaves of its score: all up to LENGTH_ANCHOR characters, less by half of each doubling beyond (this module's formula;
    only the anchor is given). Unknown lengths leave all."""
    return F.coalesce(1 / (1 + 0.5 * F.log2(F.greatest(chars / LENGTH_ANCHOR, F.lit(1.0)))), F.lit(1.0))


def hybrid(vectors: DataFrame, texts: DataFrame, query: list[float], terms: list[str], key: str, vector: str, text: str) -> DataFrame:
    """key, vector_score, keyword_score (as a share of the best), score: pools joined, weighed and cut at MIN_SCORE, then weighed by length and
    cut at HARD_MIN_SCORE. No more than two pools of rows are joined or broadcast."""
    v = vector_pool(vectors, query, key, vector).withColumnRenamed("score", "vector_score")
    counts = counted(texts, terms, key, text)
    k = _scored(counts, terms, key, POOL)
    k = k.withColumn("keyword_score", F.col("score") / F.max("score").over(Window.partitionBy(F.lit(0)))).drop("score")
    both = v.join(k, key, "full").na.fill(0.0, ["vector_score", "keyword_score"])
    both = both.withColumn("score", VECTOR * F.col("vector_score") + KEYWORD * F.col("keyword_score")).where(F.col("score") >= MIN_SCORE)
    sized = counts.select(key, "_chars").join(F.broadcast(both.select(key)), key, "left_semi")
    sized = both.join(F.broadcast(sized), key, "left")
    return sized.withColumn("score", F.col("score") * length_share(F.col("_chars"))).drop("_chars").where(F.col("score") >= HARD_MIN_SCORE)


def keyword_search(df: DataFrame, key: str, text: str, word: str, limit: int = 10) -> DataFrame:
    """The first limit keys whose texts hold the word, case aside."""
    return df.where(F.contains(F.lower(text), F.lit(word.lower()))).select(key).orderBy(key).limit(limit)
