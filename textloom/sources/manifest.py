"""Stage manifest: what ran, with what result, and what is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom import schemas

# ---------------------------------------------------------------- fixed values
EXTRACT, CLEAN = "raw_extraction", "cleaning"
# ------------------------------------------------------------ end fixed values

RESULT = ("ok", "num_records", "duration_sec", "finished_at", "languages")


def stage_metrics(records: DataFrame) -> DataFrame:
    """Row count and sorted, non-empty languages per source."""
    return records.groupBy("source").agg(
        F.count("*").alias("num_records"),
        F.array_sort(F.collect_set(F.when(F.col("lang") != "", F.col("lang")))).alias("languages"),
    )


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    from textloom.sources.parquet_io import path_exists

    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.MANIFEST)
    return spark.read.schema(schemas.MANIFEST).json(path)


def append_manifest(rows: DataFrame, path: str) -> None:
    schemas.project(rows, schemas.MANIFEST).write.mode("append").json(path)


def latest_results(manifest: DataFrame) -> DataFrame:
    """The newest entry of every source and stage; entries of subsets are left to ``published``."""
    whole = manifest.where(F.col("subset").isNull()) if "subset" in manifest.columns else manifest
    newest = whole.groupBy("source", "stage").agg(F.max_by(F.struct(*RESULT), "finished_at").alias("r"))
    return newest.select("source", "stage", "r.*")


def latest_subsets(manifest: DataFrame, stage: str) -> DataFrame:
    """(source, subset, ok, num_records): the newest entry of every subset."""
    newest = manifest.where((F.col("stage") == stage) & F.col("subset").isNotNull()).groupBy("source", "subset")
    return newest.agg(F.max_by(F.struct("ok", "num_records"), "finished_at").alias("r")).select("source", "subset", "r.*")


def published(manifest: DataFrame, stage: str) -> DataFrame:
    """(source, subset, version, num_records, finished_at): the newest successful result of every source or subset.

    A result counts from the moment its entry is in the manifest; what a stopped run has written without one is not there.
    """
    named = manifest.where((F.col("stage") == stage) & F.col("ok") & F.col("version").isNotNull())
    fields = F.struct("version", "num_records", "finished_at")
    newest = named.groupBy("source", "subset").agg(F.max_by(fields, "finished_at").alias("r"))
    return newest.select("source", "subset", "r.*")


def stale_sources(manifest: DataFrame, stage: str, before: str) -> DataFrame:
    """Sources whose result of ``stage`` is older than the newest result published by the stage ``before``."""
    mine = published(manifest, stage).groupBy("source").agg(F.max("finished_at").alias("done"))
    theirs = published(manifest, before).groupBy("source").agg(F.max("finished_at").alias("given"))
    return mine.join(theirs, "source").where(F.col("given") > F.col("done")).select("source")


def pending_sources(
    sources: DataFrame, manifest: DataFrame, existing: DataFrame, stage: str, force: bool = False
) -> DataFrame:
    """Sources whose stage is not done: no result, or no successful newest manifest entry."""
    if force:
        return sources
    done = (
        latest_results(manifest)
        .where((F.col("stage") == stage) & F.col("ok"))
        .join(existing.select("source"), "source", "left_semi")
    )
    return sources.join(done.select("source"), "source", "left_anti")


def select_sources(
    sources: DataFrame, only: str | None = None, settings: DataFrame | None = None
) -> DataFrame:
    """One named source; else those enabled in ``settings(source, enabled)``; else all."""
    if only is not None:
        return sources.where(F.col("source") == only)
    if settings is not None:
        enabled = settings.where(F.coalesce("enabled", F.lit(True)))
        return sources.join(enabled.select("source"), "source", "left_semi")
    return sources
