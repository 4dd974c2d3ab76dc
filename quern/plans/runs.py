"""Whole runs: files to translated files, log folders to progress reports, tasks to models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.operators import emit, progress, router, translate
from quern.sources import readers
from quern.streaming import events


def _saved(spark: SparkSession, out: str, version: str, per_save: int, options: dict) -> None:
    """Translates what is staged for a version, per_save files at a time, and marks the version as whole. A stream reads the staged files, and its log
    moves on once the part of a batch is written; so a run that is stopped goes on behind its last part, and a part that was begun is written again."""
    staged, target = f"{out}/running/{version}/staged", f"{out}/segments/{version}"
    schema = spark.read.parquet(staged).schema

    def save(batch: DataFrame, number: int) -> None:
        done = translate.translate_documents(batch, "doc", **options)
        place = F.row_number().over(Window.partitionBy("doc").orderBy(F.coalesce("id", F.lit(0))))
        done.withColumn("pos", place).write.mode("overwrite").parquet(f"{target}/part={number}")

    streamed = events.stream(spark, staged, schema, per_save)
    events.run_batches(streamed, save, f"{out}/running/{version}/log")
    readers.mark_whole(spark, target)
    readers.drop_versions(spark, f"{out}/running", [version])


def saved_translations(segments: DataFrame, out: str, saves: int = 16, per_save: int | None = None, resume: bool = True, **options) -> str:
    """Translates segments (doc, id, text, maybe start, end, pos) into a new version under out/segments, saving parts as it goes, and returns the version's
    path. options go to translate_documents().

    The segments are staged in files that hold whole documents, at most saves times per_save of them; a part is made of per_save files, by default one for
    each core. A run that was stopped is finished first, from what it had staged; then what the newest whole version knows isn't sent again. Without
    resume, such a run is thrown away, and everything is sent. Older versions go once a newer one is whole."""
    spark = segments.sparkSession
    per_save = per_save or spark.sparkContext.defaultParallelism
    running, versions = f"{out}/running", f"{out}/segments"
    for v in readers.folders(spark, running):
        if resume and readers.exists(spark, f"{running}/{v}/staged/_SUCCESS"):
            _saved(spark, out, v, per_save, options)
        else:  # nothing was sent, or nothing of it is wanted
            readers.drop_versions(spark, versions, [v])
            readers.drop_versions(spark, running, [v])
    whole = readers.checkpoint_versions(spark, versions)
    known = readers.checkpoint(spark, versions) if resume else None
    version = f"v{int(whole[-1][1:]) + 1 if whole else 1:08d}"
    rows = translate.with_known(segments if "pos" in segments.columns else segments.withColumn("pos", F.col("id")), "doc", known)
    rows.repartition(saves * per_save, "doc").sortWithinPartitions("doc", "pos").write.mode("overwrite").parquet(f"{running}/{version}/staged")
    _saved(spark, out, version, per_save, options)
    readers.drop_versions(spark, versions, whole)
    return f"{versions}/{version}"


def translation_run(spark: SparkSession, path: str, out: str, kind: str | None = None, resume: bool = True, mode: str = "translated", saves: int = 16, per_save: int | None = None, **options) -> DataFrame:
    """Reads, cleans and splits files, translates their segments, and writes under out: segments (Parquet, the checkpoint of later runs),
    texts and subtitles. Returns a summary of each file. Parts are saved during the run, and a run that was stopped goes on where it was: see
    saved_translations(). options go to translate_documents().

    Each run writes a version of its own under segments, and the next one resumes from the newest whole one. Nothing that a run reads is ever overwritten.
    """
    target = saved_translations(readers.read(spark, path, kind).withColumnRenamed("path", "doc"), out, saves, per_save, resume, **options)
    rows = spark.read.parquet(target).drop("part")
    emit.translated_text(rows, "doc").write.mode("overwrite").parquet(f"{out}/translated")
    emit.srt(rows, "doc", mode).write.mode("overwrite").parquet(f"{out}/subtitles")
    timed = F.count_if(F.col("start").isNotNull() & F.col("end").isNotNull()).alias("timed")
    return rows.groupBy("doc").agg(F.count("*").alias("segments"), F.first("refine_status").alias("refine_status"), timed).withColumns({
        "mode": F.lit(mode), "segments_path": F.lit(target), "translated_path": F.lit(f"{out}/translated"), "subtitles_path": F.lit(f"{out}/subtitles"),
    })


def progress_run(files: DataFrame, name: str, device: DataFrame | None = None) -> DataFrame:
    """One report row from log files (path, content): the latest record, the median baseline, what device (one row) says of memory, and risk.
    Files are read once: a file's matches become its last record and the values within the baseline's window, and one aggregation makes the row."""
    row = progress.progress(progress.latest_and_baseline(progress.log_matches(files)))
    fields = ["shared_train_mb", "shared_used_mb", "dedicated_free_mb", "dedicated_used_mb", "dedicated_total_mb"]
    row = row.crossJoin(F.broadcast(device.limit(1))) if device is not None else row  # one row each
    row = row.withColumns({c: F.lit(None).cast("long") for c in fields if c not in row.columns})
    return progress.with_risk(row).withColumns({"name": F.lit(name), "avr_loss": F.col("loss")})


def progress_line(files: DataFrame, name: str, device: DataFrame | None = None) -> DataFrame:
    return progress_run(files, name, device).select(emit.progress_line().alias("line"))


def routed(spark: SparkSession, tasks: DataFrame, models_path: str, **options) -> DataFrame:
    return router.route(tasks, readers.models(spark, models_path), **options)


def profile_setting(profile: Column, profiles: dict[str, str], default: str) -> Column:
    """What a profile stands for; unknown ones get the default."""
    if not profiles:
        return F.lit(default)
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in profiles.items() for x in kv)), profile), F.lit(default))


def positional_merge(batch: DataFrame, lines: DataFrame, key: str | list[str] = "pos") -> DataFrame:
    """Older protocol: the n-th line refines the n-th segment; lines too many are ignored, missing or blank ones leave the base."""
    keys = [key] if isinstance(key, str) else key
    new = lines.select(*keys, F.nullif(F.trim("line"), F.lit("")).alias("_line"))
    return batch.join(new, keys, "left").withColumn("translation", F.coalesce("_line", "translation")).drop("_line")
