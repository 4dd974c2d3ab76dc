"""Tables that a job writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session, or, in a local run without one, a temporary folder."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        already = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = already.get() if already.isDefined() else None
    if not folder:
        if not (spark.sparkContext.master or "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quern-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: cuts the lineage, so that a lost executor costs no more than its last
    stage, and frees the shuffle files behind it. The tables go when the driver ends, or with drop_written()."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quern-{uuid.uuid4().hex}-{name}"
    _written.append((spark, path))
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # shuffle files go as soon as the table is there
    before = spark.conf.get(clean, None)
    spark.conf.set(clean, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(clean, before) if before is not None else spark.conf.unset(clean)
    return spark.read.schema(df.schema).parquet(path)


def dropped_at_exit(spark: SparkSession, path: str) -> None:
    """A folder that goes with the tables."""
    _written.append((spark, path))


def drop_written() -> None:
    """Deletes the tables written so far; no result that still reads them may be used afterwards."""
    while _written:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001, S110  the session may have ended before
            pass


atexit.register(drop_written)
