"""Inputs with every special case, for all operators of the package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))

ODD_ROWS = [
    (1, "one two three four five six", "en", "src1", 27),
    (2, "one two three four five six", "en", "src1", 27),
    (2, "one two three four five six", "en", "src1", 27),  # a repeated row
    (3, None, "en", "src2", None),
    (4, "", None, None, 0),
    (5, LONG, "de", "src2", len(LONG)),
    (6, "ONE two three", "en", None, 13),
    (None, "one two three four five six", "en", "src1", 27),
    (7, "you stupid worthless moron. idiot!", "en", "src3", 30),
    (8, "été 你好 \U0001f600 <|endoftext|> \\ </turn>", "fr", "src3", 20),
]


def odd_documents(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty and very long texts, repeated rows, and extra columns with clashing names."""
    docs = spark.createDataFrame(ODD_ROWS, DOCUMENTS)
    extra = ["score", "Score", "n", "fp", "group", "a", "b", "slot", "offset", "sequence_id", "key", "shard", "query"]
    return docs.selectExpr("*", "'x' AS Text", "'x' AS DOC_ID", *[f"'x' AS `{c}`" for c in extra])


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENTS)


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
