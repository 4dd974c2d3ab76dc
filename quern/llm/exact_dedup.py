"""Exact deduplication, in DataFrame operations only.

Texts are grouped by a 128-bit hash of their content and, inside a hash group, by their bytes, so that a collision never merges two texts.
Grouping is by key, with partial aggregation before the shuffle: of a text that a third of all rows repeat, every task sends one row. Rows
find their class by two independent hashes, so the text itself is shuffled once at most; the join's hot keys are left to AQE to split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import ascii_lower, table, unused


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", content_hash=None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id (id of the row that stays of its class), group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. Null text counts as empty. keep: "smallest" or "largest" id of a class. Null ids
    never win against others; a class of null ids alone has keep_id null and keeps its rows. Rows that repeat the winning id are kept alike.
    An empty table gives an empty result; further columns of docs, whatever their names, are ignored. content_hash: column to column; its
    default is MD5, of 128 bits; any other hash, however weak, gives the same classes.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    content_hash = content_hash or (lambda t: F.unhex(F.md5(t)))
    norm = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    hashed = docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm")).withColumn("h", content_hash(F.col("norm")))
    groups = (
        hashed.groupBy("h", "norm")
        .agg(F.count(F.lit(1)).alias("group_size"), best("doc_id").alias("keep_id"))
        .select("h", F.sha2("norm", 256).alias("text_sha256"), "group_size", "keep_id")
    )
    rows = hashed.select("doc_id", "h", F.sha2("norm", 256).alias("text_sha256"))
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return rows.join(groups, ["h", "text_sha256"]).select("doc_id", "keep_id", "group_size", same.alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """docs without the rows that classes() doesn't keep; all columns stay, whatever their names. Rows with one id and one text both stay or
    both go; rows that share an id but not a text are judged apart. Null texts count as empty, null ids lose against others. An empty table
    gives an empty result."""
    keys = classes(docs, id_col, text_col, keep).where("not kept").select("doc_id", "text_sha256").distinct()
    gone, sha, own = (unused(docs, n) for n in ("gone", "gone_sha", "own_sha"))
    keys = keys.toDF(gone, sha)
    marked = docs.withColumn(own, F.sha2(ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), 256))
    return marked.join(keys, F.col(id_col).eqNullSafe(F.col(gone)) & (F.col(own) == F.col(sha)), "left_anti").select(*(marked[c] for c in docs.columns))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"), keep="largest")


OP2_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
     g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)
"""
