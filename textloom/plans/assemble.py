"""Stage 3: cleaned texts to a shuffled table of chunks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom import schemas
from textloom.operators.chunking import number_chunks
from textloom.operators.export import (
    chat_dialogues,
    compression_ratio,
    global_shuffle,
    language_stats,
    shard_number,
    stats_order,
)
from textloom.operators.mixing import mix_ordered, mix_plan, mix_sample, with_tier_overrides
from textloom.operators.ordering import range_bucket
from textloom.options import AssemblyOptions
from textloom.plans.extract import published_paths, read_published
from textloom.plans.layout import Layout
from textloom.sources import manifest as M
from textloom.sources.catalog import SourceSpec, sources_table
from textloom.sources.parquet_io import write_json, write_table

BY_SOURCE = schemas.T.StructType([*schemas.TEXT, schemas.T.StructField("source", schemas.T.StringType())])
DIALOGUES_BY_SOURCE = schemas.T.StructType([*schemas.DIALOGUE, schemas.T.StructField("source", schemas.T.StringType())])
MOST_SHARD_TASKS = 100_000
PART_OF_SHARD = schemas.T.StructType([*schemas.CHUNK, schemas.T.StructField("shard", schemas.T.LongType())])


def cleaned_paths(spark: SparkSession, layout: Layout, content_type: str) -> list[str]:
    return published_paths(spark, layout, M.CLEAN, layout.cleaned, content_type)


def source_counts(spark: SparkSession, specs: Iterable[SourceSpec], layout: Layout) -> DataFrame:
    """Rows of every source with a published cleaned table."""
    there = [(s.name,) for s in specs if published_paths(spark, layout, M.CLEAN, layout.cleaned, s.content_type, s.name)]
    cleaned = M.published(M.load_manifest(spark, layout.manifest), M.CLEAN)
    existing = spark.createDataFrame(there, "source string")
    return cleaned.join(existing, "source", "left_semi").select("source", "num_records")


def measured_ratio(spark: SparkSession, paths: list[str]) -> tuple[float, int]:
    """Text bytes per Parquet byte of the cleaned texts, and their text bytes."""
    if not paths:
        return 1.0, 0
    row = compression_ratio(spark, *paths).first()
    return row["ratio"], row["raw_bytes"]


def output_files(shards: DataFrame) -> int:
    """As many shuffled files as there are shards, so they have the wanted size, but use all of the cluster."""
    last = shards.agg(F.max("shard").alias("n")).first()["n"] or 0
    return max(last + 1, int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def run_assembly(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    layout: Layout,
    rules: DataFrame | None = None,
    options: AssemblyOptions = AssemblyOptions(),
) -> int:
    """Plan, sample, chunk, shard, count and shuffle.  Returns the number of chunks.

    The chunk shards are the only intermediate table: statistics and the shuffle
    read them instead of cutting the documents again.
    """
    specs = list(specs)
    if rules is None:
        rules = spark.createDataFrame([], schemas.RULE)
    sources = with_tier_overrides(sources_table(spark, specs), options.tier_overrides)
    plan = mix_plan(sources, source_counts(spark, specs, layout), rules, options.base_tier)
    paths = cleaned_paths(spark, layout, "text")
    texts = read_published(spark, paths, BY_SOURCE, layout.cleaned("text"))
    if options.shuffle_documents:
        order = ["_hash", "doc_id", "part"]
        docs = mix_sample(texts, plan, options.seed)
    else:
        order = ["doc_id", "part"]
        docs = mix_ordered(range_bucket(texts, "doc_id", "_bucket"), plan, order)

    ratio, text_bytes = measured_ratio(spark, paths)
    shard_bytes = max(1, int(options.shard_bytes * ratio))

    numbered = number_chunks(docs, ["source", "_bucket"], order, options.chunking)
    shards = numbered.select(
        *schemas.CHUNK.names, shard_number(F.col("byte_start"), shard_bytes).alias("shard")
    )
    # one file per shard, in id order: as many tasks as shards, each bounded in size
    tasks = max(1, min(MOST_SHARD_TASKS, 2 * text_bytes // shard_bytes + 1))
    gathered = shards.repartitionById(tasks, (F.col("shard") % tasks).cast("int")).sortWithinPartitions("shard", "id")
    total = write_table(gathered, layout.chunk_shards, partition_by=("shard",))

    written = spark.read.schema(PART_OF_SHARD).parquet(layout.chunk_shards)
    chunks = written.drop("shard")
    write_json(language_stats(chunks), layout.language_stats, *stats_order())
    write_table(global_shuffle(chunks, options.seed, ["id"], output_files(written)), layout.dataset)
    write_chat(spark, layout, options)
    return total


def write_chat(spark: SparkSession, layout: Layout, options: AssemblyOptions) -> int:
    """The cleaned dialogues within the given bounds, in seeded random order; returns their number."""
    paths = cleaned_paths(spark, layout, "dialogue")
    if not paths:
        return 0
    dialogues = read_published(spark, paths, DIALOGUES_BY_SOURCE, layout.cleaned("dialogue"))
    chosen = chat_dialogues(dialogues, options.min_messages, options.max_tokens, options.chunking)
    return write_table(global_shuffle(chosen, options.seed, ["source", "doc_id"]), layout.dialogues)
