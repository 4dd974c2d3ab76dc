"""Streaming forms of event queries: incremental scans with a high-water mark kept by the checkpoint, and windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_counts(events: DataFrame, key: str, ts: str = "ts", every: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events of each key and window; rows later than the watermark are dropped, and a window's row is final."""
    at = events.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", late)
    return at.groupBy(F.window("_at", every), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there and stops; the checkpoint moves on only after a batch is written whole."""
    query = df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_batches(df: DataFrame, each, checkpoint: str) -> None:
    """Calls each(batch, number) for every micro-batch of what is there. A batch that fails is given again, with its number."""
    df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
