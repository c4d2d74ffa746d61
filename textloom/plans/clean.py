"""Stage 2: raw tables to cleaned tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from textloom import schemas
from textloom.operators.records import clean_dialogues, clean_records
from textloom.options import CleanOptions
from textloom.plans.extract import Outcome, each_source, pending, published_paths, read_published
from textloom.plans.layout import Layout
from textloom.session import spread
from textloom.sources import manifest as M
from textloom.sources.catalog import SourceSpec
from textloom.sources.parquet_io import file_counts, write_table


def run_clean(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    layout: Layout,
    options: CleanOptions = CleanOptions(),
    force: bool = False,
    at_once: int = 4,
) -> dict[str, dict[str, int]]:
    """Clean every pending source that has a raw table.  Returns input and output rows per source."""

    def clean(spec: SourceSpec, _: str | None, path: str) -> tuple[dict[str, int], Outcome]:
        given = raw_of(spec)
        raw = read_published(spark, given, schemas.BY_CONTENT[spec.content_type], layout.raw(spec.content_type))
        transform = clean_dialogues if spec.content_type == "dialogue" else clean_records
        rows_out = write_table(transform(spread(raw, "doc_id"), options), path)
        rows_in, bad_files = file_counts(spark, given)
        return {"input": rows_in, "output": rows_out}, Outcome(rows=rows_out, bad_files=bad_files)

    def raw_of(spec: SourceSpec) -> list[str]:
        return published_paths(spark, layout, M.EXTRACT, layout.raw, spec.content_type, spec.name)

    extracted = [s for s in specs if raw_of(s)]
    todo = pending(spark, extracted, layout, M.CLEAN, layout.cleaned, force, after=M.EXTRACT)
    found = each_source(spark, [(s, None) for s in todo], layout, M.CLEAN, layout.cleaned, clean, at_once)
    return {name: result for (name, _), result in found.items()}
