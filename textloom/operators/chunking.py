"""Cutting documents into overlapping, token-budgeted chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.binding import bind
from textloom.operators.ordering import exclusive_prefix
from textloom.options import ChunkOptions


def chars_per_token(lang: Column, options: ChunkOptions) -> Column:
    default = F.lit(float(options.default_chars_per_token))
    pairs = [F.lit(x) for lang_value in options.chars_per_token.items() for x in lang_value]
    if not pairs:
        return default
    return F.coalesce(F.try_element_at(F.create_map(*pairs).cast("map<string,double>"), lang), default)


def chunk_budgets(lang: Column, options: ChunkOptions) -> Column:
    """Character budgets of a language: struct of target, stride and minimum length.

    The safety margin widens the target only.
    """

    def budgets(cpt: Column) -> Column:
        target = (F.lit(options.target_tokens) * cpt * F.lit(options.safety_margin)).cast("int")
        stride = F.greatest((F.lit(options.stride_tokens) * cpt).cast("int"), F.lit(1))
        shortest = F.greatest((F.lit(options.min_tokens) * cpt).cast("int"), F.lit(1))
        return F.struct(target.alias("target"), stride.alias("stride"), shortest.alias("min"))

    return bind(chars_per_token(lang, options), budgets)


def chunk_count(chars: Column, budget: Column, max_chunks: int | None) -> Column:
    """Chunks of a text of ``chars`` characters: windows start every stride and must reach the minimum."""
    windows = F.floor((chars - budget["min"]) / budget["stride"]) + 1
    enough = (chars >= budget["min"]) & (budget["target"] >= budget["min"])
    limited = windows if max_chunks is None else F.least(windows, F.lit(max_chunks))
    return F.when(enough, limited).otherwise(F.lit(0)).cast("int")


def chunk_texts(text: Column, lang: Column, options: ChunkOptions) -> Column:
    """Array of the chunk texts of a document."""

    def windows(t: Column, budget: Column) -> Column:
        n = chunk_count(F.length(t), budget, options.max_chunks)
        pieces = bind(
            n,
            lambda k: F.when(
                k > 0,
                F.transform(
                    F.sequence(F.lit(0), F.greatest(k - 1, F.lit(0))),
                    lambda i: F.substring(t, i * budget["stride"] + 1, budget["target"]),
                ),
            ),
        )
        return F.coalesce(pieces, F.array().cast("array<string>"))

    most = options.max_document_chars
    whole = F.coalesce(text if most is None else F.substring(text, 1, most), F.lit(""))
    return bind(whole, lambda t: bind(chunk_budgets(lang, options), lambda b: windows(t, b)))


def chunk_rows(docs: DataFrame, options: ChunkOptions) -> DataFrame:
    """One row per chunk, with its number ``k`` within the document; keeps the other columns."""
    rest = [c for c in docs.columns if c != "text"]
    chunks = chunk_texts(F.col("text"), F.col("lang"), options)
    exploded = docs.select(*rest, F.posexplode(chunks).alias("k", "text"))
    return exploded.withColumn("char_count", F.length("text").cast("long"))


def chunk_rows_sizes(docs: DataFrame, sizes: Sequence[ChunkOptions]) -> DataFrame:
    """Chunks of several sizes in one pass over the texts: ``target_tokens`` tells the size, ``k`` counts within it."""
    rest = [c for c in docs.columns if c != "text"]

    def cut(options: ChunkOptions) -> Column:
        texts = chunk_texts(F.col("text"), F.col("lang"), options)
        return F.transform(
            texts, lambda t, k: F.struct(F.lit(options.target_tokens).alias("target_tokens"), k.alias("k"), t.alias("text"))
        )

    exploded = docs.select(*rest, F.explode(F.concat(*map(cut, sizes))).alias("_chunk")).select(*rest, "_chunk.*")
    return exploded.withColumn("char_count", F.length("text").cast("long"))


def window_bytes(text: Column, lang: Column, options: ChunkOptions) -> Column:
    """Struct of ``chunks`` and ``bytes``: number and UTF-8 bytes of the chunks of a text, without making them.

    In a text of one-byte characters the bytes follow from its length; only other texts are cut to be measured.
    """
    most = options.max_document_chars
    whole = F.coalesce(text if most is None else F.substring(text, 1, most), F.lit(""))

    def measure(t: Column, b: Column) -> Column:
        n = chunk_count(F.length(t), b, options.max_chunks)

        def plain(k: Column) -> Column:
            # all windows that end within the text are full, the others reach its end
            full = F.least(k, F.greatest(F.floor((F.length(t) - b["target"]) / b["stride"]) + 1, F.lit(0))).cast("long")
            rest = k - full
            before = (full + k - 1) * rest / 2 * b["stride"]  # starts of the windows cut short
            return full * b["target"] + rest * F.length(t) - before.cast("long")

        def cut(k: Column) -> Column:
            starts = F.sequence(F.lit(0), F.greatest(k - 1, F.lit(0)))
            pieces = F.transform(starts, lambda i: F.octet_length(F.substring(t, i * b["stride"] + 1, b["target"])).cast("long"))
            return F.aggregate(pieces, F.lit(0).cast("long"), lambda total, size: total + size)

        size = lambda k: F.when(k == 0, 0).when(F.octet_length(t) == F.length(t), plain(k)).otherwise(cut(k))
        return bind(n, lambda k: F.struct(k.cast("long").alias("chunks"), size(k).cast("long").alias("bytes")))

    return bind(whole, lambda t: bind(chunk_budgets(lang, options), lambda b: measure(t, b)))


def number_chunks(
    docs: DataFrame, buckets: list[str], order: list[str], options: ChunkOptions
) -> DataFrame:
    """Chunk rows with a dense global ``id`` and ``byte_start``, the UTF-8 bytes of all chunks before.

    The totals of the buckets are measured without cutting the texts or moving them.  Numbering then happens per
    document, so each text is cut once and crosses the network once; both running sums share that one shuffle.
    """
    size = window_bytes(F.col("text"), F.col("lang"), options)
    # a generator's input is computed once, however often its fields are used
    measured = docs.select(*buckets, F.inline(F.array(size)))
    measured = measured.select(*buckets, F.col("chunks").alias("_first_id"), F.col("bytes").alias("_first_byte"))
    cut = docs.withColumn("_chunks", chunk_texts(F.col("text"), F.col("lang"), options)).drop("text")
    sizes = F.transform("_chunks", lambda c: F.octet_length(c).cast("long"))
    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, s: a + s)
    based = exclusive_prefix(
        cut, buckets, order, {"_first_id": F.size("_chunks"), "_first_byte": total}, measured
    )
    exploded = based.select(
        "*", F.posexplode("_chunks").alias("k", "text")
    )
    earlier = F.aggregate(
        F.slice("_chunks", F.lit(1), F.col("k")),
        F.lit(0).cast("long"),
        lambda a, c: a + F.octet_length(c),
    )
    return exploded.select(
        (F.col("_first_id") + F.col("k")).alias("id"),
        *[c for c in docs.columns if c != "text"],
        "k",
        "text",
        F.length("text").cast("long").alias("char_count"),
        (F.col("_first_byte") + earlier).alias("byte_start"),
    )
