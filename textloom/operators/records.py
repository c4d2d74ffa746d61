"""Cleaning and validation of whole records.

Only the cheap tests are ``where`` clauses, which reach the scan.  The costly
ones live inside ``explode(filter(...))``, where rows that fail drop out: a ``where``
on the cleaned text would be pushed below its projection by the optimiser and run
the whole chain once per mention, and one on the raw text would be pushed below a
repartitioning meant to spread that very work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.cleaning import clean_normalized, nfkc, nfkc_each, within
from textloom.functions.validation import is_garbage, is_valid, looks_like_code
from textloom.options import CleanOptions
from textloom.session import scratch_path

UNKNOWN = "unknown"


def allowed_language(lang: Column, allowed: tuple[str, ...]) -> Column:
    """Language allow-list; a missing language counts as ``unknown``.  Reaches the scan."""
    known = lang.isin(*allowed)
    return known | lang.isNull() if UNKNOWN in allowed else known


def _acceptable(text: Column, options: CleanOptions) -> Column:
    """Tests on the raw text that need no cleaning; what fails them would clean to an invalid text."""
    test = within(text, options.max_text_chars) & ~is_garbage(text)
    return ~looks_like_code(text) & test if options.remove_code else test


def clean_records(df: DataFrame, options: CleanOptions = CleanOptions()) -> DataFrame:
    """Text records: language, code, garbage, clean, valid.  Other columns pass through."""
    text = F.col("text")
    raw = df.where(allowed_language(F.col("lang"), options.allowed_langs) & (text != ""))
    rest = [c for c in df.columns if c != "text"]
    # two generators: only acceptable texts reach the Python step between them
    passed = raw.select(*rest, F.explode(F.filter(F.array(text), lambda t: _acceptable(t, options))).alias("text"))
    normal = passed.select(*rest, nfkc(text).alias("text"))
    cleaned = F.filter(F.array(clean_normalized(text)), lambda t: is_valid(t))
    return normal.select(*rest, F.explode(cleaned).alias("text")).select(*df.columns)


def clean_dialogues(df: DataFrame, options: CleanOptions = CleanOptions()) -> DataFrame:
    """Dialogue records: one bad message drops the dialogue, empty messages stay as they are."""
    messages = F.coalesce(F.col("messages"), F.array().cast(df.schema["messages"].dataType))

    def blank(text: Column) -> Column:
        return text.isNull() | (text == "")

    raw = df.where(allowed_language(F.col("lang"), options.allowed_langs))
    acceptable = F.forall(messages, lambda m: blank(m["content"]) | _acceptable(m["content"], options))

    def rebuilt(m: Column, normalized: Column) -> Column:
        empty = blank(m["content"])
        content = F.when(empty, m["content"]).otherwise(clean_normalized(normalized))
        return F.struct(m["role"].alias("role"), content.alias("content"), empty.alias("empty"))

    rest = [c for c in df.columns if c != "messages"]
    # only acceptable dialogues reach the Python step
    passed = raw.select(*rest, F.explode(F.when(acceptable, F.array(messages))).alias("messages"))
    contents = F.transform("messages", lambda m: m["content"])
    normal = passed.select("*", nfkc_each(contents).alias("_normal"))
    cleaned = F.filter(
        F.array(F.zip_with("messages", "_normal", rebuilt)),
        lambda ms: F.forall(ms, lambda m: m["empty"] | is_valid(m["content"])),
    )
    kept = normal.select(*rest, F.explode(cleaned).alias("messages"))
    plain = F.transform(
        "messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))
    )
    return kept.withColumn("messages", plain).select(*df.columns)


def clean_turns(
    turns: DataFrame, dialogue: str, text: str, options: CleanOptions = CleanOptions()
) -> DataFrame:
    """Dialogues kept as one row per message: the same rules, without ever gathering a dialogue.

    The cleaned messages are stored once, since they are needed twice: for the
    dialogues with a bad message and for the messages of the others.  A dialogue of
    any length is fine; adaptive execution splits it in the anti-join.
    """
    spark = turns.sparkSession
    message = F.col(text)
    blank = message.isNull() | (message == "")
    raw = turns.where(allowed_language(F.col("lang"), options.allowed_langs))
    rest = [c for c in turns.columns if c != text]
    # blank messages stay; what is not acceptable becomes null and does not reach the Python step
    tested = F.struct(F.when(blank, message).when(_acceptable(message, options), message).alias(text), blank.alias("_blank"))
    normal = raw.select(*rest, F.inline(F.array(tested))).select(*rest, "_blank", nfkc(F.col(text)).alias(text))
    content = F.when(F.col("_blank"), message).otherwise(clean_normalized(message))
    checked = F.transform(
        F.array(content),
        lambda c: F.struct(c.alias(text), F.coalesce(F.col("_blank") | is_valid(c), F.lit(False)).alias("_ok")),
    )
    cleaned = normal.select(*rest, F.inline(checked))
    path = scratch_path(spark, "turns")
    cleaned.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(cleaned.schema).parquet(path)
    bad = stored.where(~F.col("_ok")).select(dialogue).distinct()
    return stored.where("_ok").join(bad, dialogue, "left_anti").select(*turns.columns)


def clean_funnel(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows in, rows out and sorted languages of the kept rows, per source."""
    before = raw.groupBy("source").agg(F.count("*").alias("rows_in"))
    after = cleaned.groupBy("source").agg(
        F.count("*").alias("rows_out"),
        F.array_sort(F.collect_set("lang")).alias("languages"),
    )
    return before.join(after, "source", "left").select(
        "source",
        "rows_in",
        F.coalesce("rows_out", F.lit(0)).alias("rows_out"),
        F.coalesce("languages", F.array().cast("array<string>")).alias("languages"),
    )
