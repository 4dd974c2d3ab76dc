"""The corpus pipeline: five stages from raw documents to token ids, each one operator of quern.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import bpe, decontamination, exact_dedup, ngram_join, toxicity
from quern.llm.common import table, written
from quern.llm.labelled import remainder


# The first four stages return rows of docs as they are, with all their columns, whatever their names; an empty table stays empty, and texts of
# any length count whole. What else there is to say of nulls, repeated rows and ties stands at each.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring 0.7 or more go. The model is trained on the labelled rows of the table of documents, but for the held-out fold.

    Rows are judged one by one by their texts: null and empty texts score 0 and stay; repeated rows, repeated and null ids make no difference;
    a score of 0.7 exactly goes. Without labels of both kinds nothing goes."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.trained(table(spark, sf_dir, "documents"), labels, "toxic", remainder("doc_id", 3) != 1)
    return toxicity.kept(docs, model, threshold=0.7)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays.

    Null texts count as empty, so of rows without text one id stays. Null ids lose against others; among themselves all stay. Rows that repeat
    both id and text of the one that stays all stay. An id with several texts is judged for each."""
    return exact_dedup.deduplicated(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the one with the least doc_id stays.

    Texts without words, null ones included, are linked with nothing and stay. Rows with null ids stay. Rows that share the least id of their
    group all stay; an id with several texts is judged for each."""
    return ngram_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, at a similarity of 0.8, go.

    Rows are judged one by one by their texts: null and empty texts stay; repeated rows, repeated and null ids make no difference. An empty
    benchmark leaves all; items of fewer than 24 normalised bytes count only where they stand exactly, as whole words."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left, a row for each row; null texts count as empty and have no tokens."""
    return bpe.digest(docs, bpe.vocabulary())


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_jaccard", drop_near_copies), ("decontamination", drop_leaks), ("bpe", tokenise)]

#: The toxicity stage is a trained model, which SQL can't express; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the table of documents. What each stage returns is written as Parquet and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
