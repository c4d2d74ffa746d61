"""Incremental cleaning: the clean stage over a folder that keeps receiving files.

Cleaning looks at one record at a time, so the batch transform runs unchanged on
a stream; the checkpoint remembers which files were done.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textloom.operators.records import clean_dialogues, clean_records
from textloom.options import CleanOptions


def clean_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    options: CleanOptions = CleanOptions(),
    content_type: str = "text",
    slots: int | None = None,
) -> StreamingQuery:
    """Clean all files not yet seen, then stop.  ``slots`` spreads input of few, large files."""
    clean = clean_dialogues if content_type == "dialogue" else clean_records
    raw = spark.readStream.schema(schema).parquet(source)
    if slots is not None:
        raw = raw.repartition(slots, "doc_id")
    return (
        clean(raw, options)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .trigger(availableNow=True)
        .start()
    )
