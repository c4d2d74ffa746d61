"""Statistics, shards and the shuffled export of chunk rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.chunking import chars_per_token
from textloom.operators.ordering import hash_bucket, seeded_hash
from textloom.options import ChunkOptions


def stats_order() -> tuple[Column, Column]:
    return F.desc("chars"), F.asc("lang")


def language_stats(chunks: DataFrame) -> DataFrame:
    """Chunks and characters per language, most characters first."""
    stats = chunks.groupBy("lang").agg(
        F.count("*").alias("records"), F.sum("char_count").alias("chars")
    )
    return stats.orderBy(*stats_order())


def shard_number(byte_start: Column, shard_bytes: int | Column) -> Column:
    """Shard of a chunk that starts after ``byte_start`` bytes: shards hold the target within one row."""
    size = F.lit(shard_bytes) if isinstance(shard_bytes, int) else shard_bytes
    return F.floor(byte_start / size).cast("long")


def global_shuffle(chunks: DataFrame, seed: int, keys: list[str], partitions: int | None = None) -> DataFrame:
    """All rows in seeded random order: partition by partition, and sorted inside each.

    The partition is computed from the hash itself, so no sampling pass over the
    input is needed, and md5 fills the partitions evenly.
    """
    if partitions is None:
        partitions = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = chunks.withColumn("_hash", seeded_hash(seed, *keys))
    share = hash_bucket(F.col("_hash"), 7).cast("long")  # 28 bits
    placed = hashed.repartitionById(partitions, F.shiftright(share * partitions, 28).cast("int"))
    return placed.sortWithinPartitions("_hash", *keys).drop("_hash")


def compression_ratio(spark: SparkSession, *paths: str) -> DataFrame:
    """``(raw_bytes, rows, parquet_bytes, ratio)``: UTF-8 bytes of text per Parquet byte of written tables.

    All files count: one pass over the text column, and the lengths in the listing of the files.  An empty table has the ratio 1.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    stored = files.load(list(paths)).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    texts = spark.read.parquet(*paths)
    size = F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))
    raw = texts.agg(size.alias("raw_bytes"), F.count("*").alias("rows"), F.lit(stored).cast("long").alias("parquet_bytes"))
    measured = F.when((F.col("raw_bytes") > 0) & (F.col("parquet_bytes") > 0), F.col("raw_bytes") / F.col("parquet_bytes"))
    return raw.select("*", F.coalesce(measured, F.lit(1.0)).alias("ratio"))


def chat_dialogues(
    dialogues: DataFrame,
    min_messages: int | None = None,
    max_tokens: int | None = None,
    options: ChunkOptions = ChunkOptions(),
) -> DataFrame:
    """Dialogues with ``n_messages`` and ``est_tokens`` (characters by those of a token); bounds are off by default."""
    chars = F.aggregate(
        "messages", F.lit(0).cast("long"), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0))
    )
    tokens = F.ceil(chars / chars_per_token(F.col("lang"), options)).cast("long")
    counted = dialogues.select("*", F.size("messages").alias("n_messages"), tokens.alias("est_tokens"))
    if min_messages is not None:
        counted = counted.where(F.col("n_messages") >= min_messages)
    return counted if max_tokens is None else counted.where(F.col("est_tokens") <= max_tokens)
