"""Stage 1: source records to raw tables."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom import schemas
from textloom.plans.layout import Layout
from textloom.sources import catalog
from textloom.sources import manifest as M
from textloom.sources.catalog import SourceSpec, sources_table
from textloom.sources.parquet_io import path_exists, remove_folder, write_table

logger = logging.getLogger(__name__)
Result = TypeVar("Result")


def published_paths(
    spark: SparkSession, layout: Layout, stage: str, place: Callable[[str, str], str], content_type: str, source: str | None = None
) -> list[str]:
    """Folders of the results that count, of one source or of all of a content type."""
    rows = M.published(M.load_manifest(spark, layout.manifest), stage)
    if source is not None:
        rows = rows.where(F.col("source") == source)
    found = rows.select("source", "subset", "version").collect()  # as many rows as sources and subsets
    paths = [layout.version(place(content_type, r["source"]), r["subset"], r["version"]) for r in found]
    return sorted(p for p in paths if path_exists(spark, p))


def read_published(spark: SparkSession, paths: list[str], schema: T.StructType, base: str) -> DataFrame:
    """The rows of published results; ``base`` is the folder whose ``source=`` folders hold them."""
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def pending(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    layout: Layout,
    stage: str,
    place: Callable[[str, str], str],
    force: bool,
    after: str | None = None,
) -> list[SourceSpec]:
    """The sources a stage still has to process: not done, or done before the newest result of the stage ``after``."""
    specs = list(specs)
    known = M.load_manifest(spark, layout.manifest)
    done = {(r["source"], r["subset"], r["version"]) for r in M.published(known, stage).select("source", "subset", "version").collect()}
    there = [
        (s.name,)
        for s in specs
        if any(path_exists(spark, layout.version(place(s.content_type, s.name), sub, v)) for name, sub, v in done if name == s.name)
    ]
    existing = spark.createDataFrame(there, "source string")
    todo = M.pending_sources(sources_table(spark, specs), known, existing, stage, force).select("source")
    if after is not None:
        todo = todo.union(M.stale_sources(known, stage, after))
    names = {r["source"] for r in todo.collect()}  # as many rows as sources
    return [s for s in specs if s.name in names]


@dataclass
class Outcome:
    """What became of a source or of one of its subsets; it failed if it names itself or a subset as failed."""

    rows: int = 0
    version: str | None = None
    bad_files: list[str] = field(default_factory=list)
    bad_lines: int = 0
    failed_subsets: list[str] = field(default_factory=list)


def record_result(
    spark: SparkSession, layout: Layout, name: str, stage: str, started: float, outcome: Outcome, subset: str | None = None, languages: list[str] | None = None
) -> None:
    """Append a manifest entry; it publishes the version the outcome names."""
    row = (
        name, stage, not outcome.failed_subsets, outcome.rows, round(time.time() - started, 2), datetime.now(timezone.utc), languages or [], subset,
        outcome.version, outcome.bad_files, outcome.bad_lines, outcome.failed_subsets,
    )
    M.append_manifest(spark.createDataFrame([row], schemas.MANIFEST), layout.manifest)


def languages_of(spark: SparkSession, path: str, rows: int, name: str) -> list[str]:
    """The languages of a written result, whose rows must be those that were counted while writing."""
    metrics = M.stage_metrics(spark.read.parquet(path).withColumn("source", F.lit(name))).first()
    found = metrics["num_records"] if metrics else 0
    if found != rows:
        raise OSError(f"{path}: {rows} rows were written, {found} can be read")
    return metrics["languages"] if metrics else []


def each_source(
    spark: SparkSession,
    tasks: list[tuple[SourceSpec, str | None]],
    layout: Layout,
    stage: str,
    place: Callable[[str, str], str],
    work: Callable[[SourceSpec, str | None, str], tuple[Result, Outcome]],
    at_once: int,
) -> dict[tuple[str, str | None], Result]:
    """Run ``work(spec, subset, path)`` for sources and subsets, several at once, and append each outcome to the manifest.

    Small sources leave most of a cluster idle, so their jobs overlap.  Every task writes to a fresh version folder, and only
    its manifest entry makes readers use it: a run that stops before leaves the older result in place.  A failure is recorded,
    so the next run tries that source or subset again; it does not stop the others.  The version before the newest stays for
    readers that have just begun; older ones are removed.
    """
    results: dict[tuple[str, str | None], Result] = {}
    if not tasks:
        return results
    started: dict[tuple[str, str | None], float] = {}

    def timed(spec: SourceSpec, subset: str | None, version: str) -> tuple[Result, Outcome, list[str]]:
        started[spec.name, subset] = time.time()
        path = layout.version(place(spec.content_type, spec.name), subset, version)
        with catalog.noticing() as noticed:
            try:
                result, outcome = work(spec, subset, path)
            finally:
                for scratch in noticed.scratch:
                    remove_folder(spark, scratch)
        outcome.version, outcome.bad_lines = version, noticed.bad_lines
        return result, outcome, languages_of(spark, path, outcome.rows, spec.name)

    with ThreadPoolExecutor(at_once) as pool:
        futures = {}
        for spec, subset in tasks:
            futures[pool.submit(inheritable_thread_target(spark)(timed), spec, subset, new_version())] = (spec, subset)
        for future in as_completed(futures):
            spec, subset = futures[future]
            outcome, languages = Outcome(failed_subsets=[spec.name if subset is None else subset]), []
            try:
                results[spec.name, subset], outcome, languages = future.result()
            except Exception:
                logger.exception("%s failed for source %s%s", stage, spec.name, f", subset {subset}" if subset is not None else "")
            record_result(spark, layout, spec.name, stage, started.get((spec.name, subset), time.time()), outcome, subset, languages)
            if outcome.version is not None:
                drop_old_versions(spark, layout, stage, place(spec.content_type, spec.name), spec.name, subset)
    return results


def new_version() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def drop_old_versions(spark: SparkSession, layout: Layout, stage: str, folder: str, name: str, subset: str | None, keep: int = 2) -> None:
    """Remove what the manifest names as results older than the newest ``keep``."""
    mine = M.load_manifest(spark, layout.manifest).where((F.col("stage") == stage) & (F.col("source") == name) & F.col("ok"))
    mine = mine.where(F.col("subset").eqNullSafe(F.lit(subset)) & F.col("version").isNotNull())
    versions = [r["version"] for r in mine.orderBy(F.desc("finished_at")).select("version").collect()]
    for version in versions[keep:]:
        remove_folder(spark, layout.version(folder, subset, version))


def run_extract(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    landed_root: str,
    layout: Layout,
    force: bool = False,
    at_once: int = 4,
) -> dict[str, int]:
    """Write the raw table of every pending source.  Returns rows per source.

    Landed files of a source lie in ``<landed_root>/<name>``.  A source that is divided by a landed partition column
    has a job, a result and a manifest entry for each of its subsets: one that fails leaves the others in the raw table, the
    entry of the source names it, and the next run tries only that one again.
    """
    todo = pending(spark, specs, layout, M.EXTRACT, layout.raw, force)
    begun = time.time()
    done = set()
    if not force:
        fine = M.latest_subsets(M.load_manifest(spark, layout.manifest), M.EXTRACT).where("ok").collect()  # one row per subset
        done = {(r["source"], r["subset"]) for r in fine}
    tasks: list[tuple[SourceSpec, str | None]] = []
    divided: dict[str, list[str]] = {}
    for spec in todo:
        subsets = catalog.landed_subsets(spark, f"{landed_root}/{spec.name}", spec.subset_column) if spec.subset_column else []
        if subsets:
            divided[spec.name] = subsets
            tasks += [(spec, s) for s in subsets if (spec.name, s) not in done]
        else:
            tasks.append((spec, None))

    def extract(spec: SourceSpec, subset: str | None, path: str) -> tuple[int, Outcome]:
        source = f"{landed_root}/{spec.name}"
        records = spec.build(spark, source) if subset is None else spec.build(spark, source, subset)
        records = schemas.project(records, schemas.BY_CONTENT[spec.content_type])
        rows = write_table(records, path)
        return rows, Outcome(rows=rows)

    found = each_source(spark, tasks, layout, M.EXTRACT, layout.raw, extract, at_once)
    results = {name: rows for (name, subset), rows in found.items() if subset is None}
    for name, subsets in divided.items():
        entries = M.latest_subsets(M.load_manifest(spark, layout.manifest), M.EXTRACT).where(F.col("source") == name).collect()
        state = {r["subset"]: r for r in entries}
        failed = [s for s in subsets if s not in state or not state[s]["ok"]]
        results[name] = sum(state[s]["num_records"] for s in subsets if s not in failed)
        whole = Outcome(rows=results[name], failed_subsets=failed)
        record_result(spark, layout, name, M.EXTRACT, begun, whole, languages=sorted(set(subsets) - set(failed)))
    return results
