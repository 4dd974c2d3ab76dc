"""Running sums across ranges against window functions."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.operators.running import running


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_equals_windows(spark, keys):
    """One key holds a third of the rows, one is null; ranges are smaller than keys."""
    k = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 != 0, F.col("id") % 50)
    df = spark.range(3000, numPartitions=5).select("id", k.alias("k"), F.when(F.col("id") % 13 > 0, F.col("id") * 7919 % 100).alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running(df, keys, [F.col("id").desc()], {"before": F.col("x")}, "pos")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    w = Window.partitionBy(*keys).orderBy(F.col("id").desc())
    want = df.select("*", (F.sum(F.coalesce("x", F.lit(0))).over(w) - F.coalesce("x", F.lit(0))).alias("before"), (F.row_number().over(w) - 1).cast("long").alias("pos"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_running_of_nothing(spark):
    df = spark.createDataFrame([], "k string, x long")
    assert running(df, ["k"], [F.col("x")], {"before": F.col("x")}, "pos").collect() == []
