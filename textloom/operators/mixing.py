"""Mixing sources by quality tier, with reproducible sampling."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.ordering import broadcast_if_small, first_per_group, hash_bucket, seeded_hash

# 65536 hash buckets per source: enough to spread a source of many terabytes, few
# enough that the table of bucket counts stays small.
HASH_DIGITS = 4


def available_sources(sources: DataFrame, counts: DataFrame) -> DataFrame:
    """Sources that have cleaned data."""
    return sources.join(counts.select("source"), "source", "left_semi")


def with_base_tier(sources: DataFrame, base_tier: int | None) -> DataFrame:
    """Add ``base_tier``: the wanted tier if any source has it, else the lowest one present."""
    everything = Window.partitionBy(F.lit(0))  # the source table: tens of rows
    wanted = F.max(F.when(F.col("tier") == F.lit(base_tier).cast("int"), F.col("tier"))).over(everything)
    return sources.withColumn("base_tier", F.coalesce(wanted, F.min("tier").over(everything)))


def mix_plan(
    sources: DataFrame, counts: DataFrame, rules: DataFrame, base_tier: int | None = None
) -> DataFrame:
    """``(source, tier, content_type, num_records, base_total, max_rows)``; null ``max_rows`` means all rows.

    A source with a proportion is limited to that share of the rows of the base
    tier, text and dialogue sources alike.
    """
    everything = Window.partitionBy(F.lit(0))
    tiers = with_base_tier(available_sources(sources, counts), base_tier).join(counts, "source")
    in_base = F.when(F.col("tier") == F.col("base_tier"), F.col("num_records"))
    totals = tiers.withColumn("base_total", F.coalesce(F.sum(in_base).over(everything), F.lit(0)))
    planned = totals.join(rules, "source", "left")
    limited = ~F.coalesce("use_all", F.lit(False)) & F.col("proportion").isNotNull()
    limit = F.when(limited, (F.col("base_total") * F.col("proportion")).cast("long"))
    return planned.select(
        "source", "tier", "content_type", "num_records", "base_total", limit.alias("max_rows")
    )


def with_shuffle_order(docs: DataFrame, seed: int) -> DataFrame:
    """Add the seeded order of documents within their source: ``_hash`` and its bucket ``_bucket``."""
    hashed = docs.withColumn("_hash", seeded_hash(seed, "source", "doc_id", "part"))
    return hashed.withColumn("_bucket", hash_bucket(F.col("_hash"), HASH_DIGITS))


def with_tier_overrides(sources: DataFrame, overrides: Mapping[str, int]) -> DataFrame:
    """``sources`` with the tiers of some replaced; the table has one row per source, so a literal map will do."""
    if not overrides:
        return sources
    table = F.create_map(*[F.lit(x) for pair in overrides.items() for x in pair])
    return sources.withColumn("tier", F.coalesce(F.try_element_at(table, F.col("source")), F.col("tier")))


def mix_ordered(docs: DataFrame, plan: DataFrame, order: list[str]) -> DataFrame:
    """Non-empty texts of text sources, each source limited as planned to its first in ``order``.

    ``docs`` has a column ``_bucket`` that is monotone in the order.
    """
    limits = broadcast_if_small(plan.where(F.col("content_type") == "text").select("source", "max_rows"))
    texts = docs.where(F.col("text") != "").join(limits.select("source"), "source", "left_semi")
    return first_per_group(texts, "source", ["_bucket"], order, limits)


def mix_sample(docs: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``mix_ordered`` in seeded order; keeps the order columns of ``with_shuffle_order``."""
    return mix_ordered(with_shuffle_order(docs, seed), plan, ["_hash", "doc_id", "part"])
