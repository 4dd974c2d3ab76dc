"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, folds: int) -> Column:
    """crc32 of an id as text, modulo folds; null ids give null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, where: Column, per_class: int) -> DataFrame:
    """text and y (0 or 1) of at most per_class labelled documents of each class, those of the least hash of doc_id among the labels for which
    where holds. Labels of one doc_id count once, as their maximum; null labels and ids don't count."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).where(where)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("y = 0").orderBy(*order).limit(per_class).unionByName(known.where("y = 1").orderBy(*order).limit(per_class))
    # per_class bounds the broadcast side: 16 bytes for each of 2 * per_class rows.
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "y")
