"""Shaping raw source tables into text records ``(doc_id, part, lang, text)``.

Texts are stripped once inside ``explode(filter(array(...)))``, which also drops
those shorter than ``min_chars``; see ``records.py`` for why not ``where``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.binding import bind
from textloom.functions.cleaning import py_strip
from textloom.operators.ordering import by_keys, first_per_group, in_groups, join_small, running_totals
from textloom.options import MIN_SOURCE_CHARS
from textloom.session import settle

RECORD = ("doc_id", "part", "lang", "text")


def _lang(lang: str | Column) -> Column:
    return F.lit(lang) if isinstance(lang, str) else lang


def _long_enough(min_chars: int):
    return lambda item: F.length(item["text"]) >= min_chars


def _item(part: Column, lang: Column, text: Column) -> Column:
    stripped = py_strip(F.coalesce(text, F.lit("")))
    return F.struct(part.cast("int").alias("part"), lang.alias("lang"), stripped.alias("text"))


def unpivot_texts(
    df: DataFrame,
    columns: Mapping[str, str | Column],
    min_chars: int = MIN_SOURCE_CHARS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One record per text column; the mapping gives each column's language.

    With one column this is the plain strip-and-minimum-length source.
    """
    items = F.array(
        *[_item(F.lit(i), _lang(lang), F.col(f"`{name}`")) for i, (name, lang) in enumerate(columns.items())]
    )
    long = df.select("doc_id", *keep, F.inline(F.filter(items, _long_enough(min_chars))))
    return long.select(*RECORD, *keep)


def nested_texts(
    df: DataFrame,
    head: str,
    parts: str,
    field: str,
    lang: str | Column,
    min_chars: int = MIN_SOURCE_CHARS,
) -> DataFrame:
    """A text column together with one text field of each element of a nested array."""
    no_parts = F.array().cast(df.schema[parts].dataType)
    texts = F.concat(
        F.array(F.col(head)), F.transform(F.coalesce(F.col(parts), no_parts), lambda p: p[field])
    )
    items = F.transform(texts, lambda t, i: _item(i, _lang(lang), t))
    return df.select("doc_id", F.inline(F.filter(items, _long_enough(min_chars)))).select(*RECORD)


def _ordered_text(order: list[str], text: str, separator: str) -> Column:
    """Texts of a group joined in key order."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_text"))))
    return F.array_join(F.transform(rows, lambda r: r["_text"]), separator)


def _stripped_lines(lines: DataFrame, text: str) -> DataFrame:
    line = F.filter(F.array(py_strip(F.coalesce(F.col(text), F.lit("")))), lambda t: t != "")
    rest = [c for c in lines.columns if c != text]
    return lines.select(*rest, F.explode(line).alias(text))


def _in_pieces(lines: DataFrame, run_id: str, text: str, buckets: list[str], order: list[str]) -> DataFrame:
    """Lines that are not blank as ``(*buckets, _at, _id, _line)``, with ``_piece``: where the run begins, as far as its bucket tells."""
    lines = _stripped_lines(lines, text).select(
        *buckets, F.struct(*order).alias("_at"), F.col(run_id).alias("_id"), F.col(text).alias("_line")
    )
    in_bucket = Window.partitionBy(*buckets).orderBy("_at")
    first_row = F.row_number().over(in_bucket) == 1
    begins = first_row | ~F.lag("_id").over(in_bucket).eqNullSafe(F.col("_id"))
    so_far = in_bucket.rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("_begins", F.when(begins, F.col("_at"))).withColumn("_piece", F.max("_begins").over(so_far)).drop("_begins")


def _edges(pieces: DataFrame, buckets: list[str], *more: Column) -> DataFrame:
    """One row per bucket: its first and last piece, and what ``more`` sums up."""
    return pieces.groupBy(*buckets).agg(
        F.min_by(F.struct("_id"), "_piece").alias("_first"),
        F.max_by(F.struct("_id"), "_piece").alias("_last"),
        F.min("_piece").alias("_first_piece"),
        F.max("_piece").alias("_last_piece"),
        *more,
    )


def concat_runs(
    lines: DataFrame,
    run_id: str,
    text: str,
    buckets: list[str],
    order: list[str],
    separator: str = " ",
    min_chars: int = MIN_SOURCE_CHARS,
) -> DataFrame:
    """Join consecutive lines with the same id; an id that comes back starts a new text.

    Returns ``(start, run_id, text)`` with ``start`` the order key of the first line.
    Lines are grouped into *pieces*, the runs inside one bucket, so neither a
    frequent id nor a long run meets in one task; a run crossing bucket bounds is
    put together from its few pieces.  Blank lines do not separate runs.
    """
    pieces = (
        _in_pieces(lines, run_id, text, buckets, order)
        .groupBy(*buckets, "_piece", "_id")
        .agg(_ordered_text(["_at"], "_line", separator).alias("_joined"))
    )
    # the joined lines are not needed for the edges and pruned from the plan
    carried = _carried(_edges(pieces, buckets), buckets)
    runs = (
        join_small(pieces, carried, ["_piece"], "left")
        .groupBy(F.coalesce("_carry", "_piece").alias("start"), F.col("_id").alias(run_id))
        .agg(_ordered_text(["_piece"], "_joined", separator).alias("text"))
    )
    return runs.where(F.length("text") >= min_chars)


def run_lines(
    lines: DataFrame,
    run_id: str,
    text: str,
    buckets: list[str],
    order: list[str],
    separator: str = " ",
    min_chars: int = MIN_SOURCE_CHARS,
) -> DataFrame:
    """The texts of ``concat_runs`` line by line: ``(start, run_id, position, <text>)``, so a run may be longer than a row.

    ``position`` counts a run's lines from 0; joining them in its order gives the text.  Positions within a bucket come from a
    window; a run that crosses bucket bounds goes on where the sums over the buckets before leave it.  Only
    buckets and the pieces of such runs are exchanged besides, one narrow row each.
    """
    placed = _in_pieces(lines, run_id, text, buckets, order)
    extra = len(separator)
    pieces = placed.groupBy(*buckets, "_piece", "_id").agg(
        F.count("*").alias("_n"), F.sum(F.length("_line").cast("long") + extra).alias("_chars")
    )
    edges, many = settle(
        _edges(
            pieces,
            buckets,
            F.sum("_n").alias("_n"),
            F.max_by("_n", "_piece").alias("_last_n"),
            F.max_by("_chars", "_piece").alias("_last_chars"),
            F.min_by("_chars", "_piece").alias("_first_chars"),
        )
    )
    carried, _ = settle(_carried(edges, buckets))
    # places of the buckets in the order of all lines, and of the pieces that later buckets go on with
    based = edges.join(running_totals(edges, buckets, ["_n"], many), buckets)
    begun = based.select(F.col("_last_piece").alias("_carry"), (F.col("_offset__n") + F.col("_n") - F.col("_last_n")).alias("_begun"), "_last_chars")
    going_on = (
        carried.join(based.select(F.col("_first_piece").alias("_piece"), "_offset__n", "_first_chars"), "_piece")
        .join(begun, "_carry")
        .select("_piece", "_carry", (F.col("_offset__n") - F.col("_begun")).alias("_skip"), "_first_chars", "_last_chars")
    )
    # characters of the runs that cross a bound: their pieces, summed on the map side
    spanning = going_on.groupBy("_carry").agg((F.sum("_first_chars") + F.first("_last_chars")).alias("_run_chars"))
    places = (
        going_on.join(spanning, "_carry")
        .select("_piece", "_carry", "_skip", "_run_chars")
        .unionByName(spanning.select(F.col("_carry").alias("_piece"), "_carry", F.lit(0).cast("long").alias("_skip"), "_run_chars"))
    )
    in_piece = Window.partitionBy(*buckets, "_piece")
    counted = placed.select(
        "*",
        (F.row_number().over(in_piece.orderBy("_at")) - 1).alias("_in"),
        F.sum(F.length("_line").cast("long") + extra).over(in_piece).alias("_chars"),
    )
    joined = join_small(counted, places, ["_piece"], "left")
    long = F.coalesce("_run_chars", "_chars") - extra >= min_chars
    return joined.where(long).select(
        F.coalesce("_carry", "_piece").alias("start"),
        F.col("_id").alias(run_id),
        (F.coalesce("_skip", F.lit(0)) + F.col("_in")).cast("long").alias("position"),
        F.col("_line").alias(text),
    )


def _carried(edges: DataFrame, buckets: list[str]) -> DataFrame:
    """(_piece, _carry): for pieces that go on with the run of the bucket before, the piece where that run starts.

    Looks back within groups of buckets; between groups the driver hands on one row each.
    """
    placed, _ = in_groups(edges, buckets)
    along = Window.partitionBy("_group").orderBy(*buckets)
    is_first = F.row_number().over(along) == 1
    # the last id of the group before
    lasts = placed.groupBy("_group").agg(F.max_by("_last", F.struct(*buckets)).alias("_last")).collect()
    lasts.sort(key=by_keys(["_group"]))
    handed = [(row["_group"], before["_last"]) for before, row in zip(lasts, lasts[1:], strict=False)]
    kind = T.StructType([T.StructField("_group", T.IntegerType()), T.StructField("_handed", edges.schema["_last"].dataType)])
    with_handed = placed.join(F.broadcast(edges.sparkSession.createDataFrame(handed, kind)), "_group", "left")
    previous = F.when(is_first, F.col("_handed")).otherwise(F.lag("_last").over(along))
    # a piece that does not go on, or is followed by another one, starts the run that the next bucket may continue
    own_start = F.when(~F.col("_continued") | (F.col("_first_piece") != F.col("_last_piece")), F.col("_last_piece"))
    seen = with_handed.withColumn("_continued", previous.eqNullSafe(F.col("_first"))).withColumn("_own", own_start)
    starts = seen.groupBy("_group").agg(F.max_by("_own", F.when(F.col("_own").isNotNull(), F.struct(*buckets))).alias("_own")).collect()
    starts.sort(key=by_keys(["_group"]))
    passed, newest = [], None
    for row in starts:
        passed.append((row["_group"], newest))
        newest = row["_own"] if row["_own"] is not None else newest
    kind = T.StructType([T.StructField("_group", T.IntegerType()), T.StructField("_passed", edges.schema["_last_piece"].dataType)])
    with_passed = seen.join(F.broadcast(edges.sparkSession.createDataFrame(passed, kind)), "_group", "left")
    within = F.last("_own", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    carry = with_passed.withColumn("_carry", F.coalesce(within, F.col("_passed")))
    return carry.where(F.col("_continued")).select(F.col("_first_piece").alias("_piece"), "_carry")


def concat_groups(
    lines: DataFrame,
    group: str,
    text: str,
    lang: str,
    buckets: list[str],
    order: list[str],
    separator: str = "\n",
    min_chars: int = MIN_SOURCE_CHARS,
) -> DataFrame:
    """Join all lines of a group in order; the language is that of its first non-blank line.

    Returns ``(start, group, lang, text)``.  Lines are joined per bucket first, so
    a large group is spread over its buckets.  Lines without an id are no group: they are only joined
    within their bucket, so however many there are they never meet in one row.
    """
    lines = _stripped_lines(lines, text).withColumn("_at", F.struct(*order))
    parts = lines.groupBy(group, *buckets).agg(
        F.min("_at").alias("_at"),
        F.min_by(F.struct(F.col(lang).alias("lang")), "_at").alias("_lang"),
        _ordered_text(["_at"], text, separator).alias("_joined"),
    )
    apart = F.when(F.col(group).isNull(), F.struct(*buckets)).alias("_apart")
    joined = parts.groupBy(group, apart).agg(
        F.min("_at").alias("start"),
        F.min_by("_lang", "_at")["lang"].alias("lang"),
        _ordered_text(["_at"], "_joined", separator).alias("text"),
    )
    return joined.drop("_apart").where(F.length("text") >= min_chars)


def group_lines(
    lines: DataFrame,
    group: str,
    text: str,
    lang: str,
    buckets: list[str],
    order: list[str],
    separator: str = "\n",
    min_chars: int = MIN_SOURCE_CHARS,
) -> DataFrame:
    """The texts of ``concat_groups`` line by line: ``(start, group, lang, position, <text>)``, so a group may be larger than a row.

    Positions are those within a bucket plus the lines of the group in earlier buckets: one narrow row per group and
    bucket is summed up and meets the lines on the partitioning their window already has.
    """
    lines = _stripped_lines(lines, text).withColumn("_at", F.struct(*order)).withColumn("_lang", F.struct(F.col(lang).alias("lang")))
    # lines without an id are no group, but one for each of their blocks
    apart = F.when(F.col(group).isNull(), F.struct(*buckets))
    extra = len(separator)
    whose = F.to_json(F.struct(F.col(group).alias("id"), apart.alias("apart"))).alias("_whose")
    lines = lines.select(*buckets, whose, F.col(group).alias("_id"), "_at", "_lang", F.col(text).alias("_line"))
    keys = ["_whose", *buckets]
    parts = lines.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.sum(F.length("_line").cast("long") + extra).alias("_chars"),
        F.min("_at").alias("_start"),
        F.min_by("_lang", "_at").alias("_first_lang"),
    )
    parts, many = settle(parts)
    wholes = parts.groupBy("_whose").agg(
        (F.sum("_chars") - extra).alias("_length"),
        F.min("_start").alias("start"),
        F.min_by("_first_lang", "_start")["lang"].alias("lang"),
        F.min(F.struct(*buckets)).alias("_first_bucket"),
    )
    before = running_totals(parts, keys, ["_n"], many)
    first = before.select("_whose", F.struct(*buckets).alias("_first_bucket"), F.col("_offset__n").alias("_base"))
    wholes = wholes.where(F.col("_length") >= min_chars).join(first, ["_whose", "_first_bucket"])
    places = before.join(wholes, "_whose").select(*keys, "start", "lang", (F.col("_offset__n") - F.col("_base")).alias("_skip"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy("_at")) - 1
    joined = lines.drop("_lang").withColumn("_in", inside).join(places, keys)
    return joined.select(
        "start", F.col("_id").alias(group), "lang", (F.col("_skip") + F.col("_in")).cast("long").alias("position"), F.col("_line").alias(text)
    )


def keep_first_by_hash(df: DataFrame, text: str, order: list[str]) -> DataFrame:
    """The first row, in key order, of every distinct text (by md5).

    Spark limits each map task to one row per hash before the shuffle, so a text
    with very many copies stays cheap.
    """
    rank = F.row_number().over(Window.partitionBy("_hash").orderBy(*order))
    hashed = df.withColumn("_hash", F.md5(F.col(text)))
    return hashed.withColumn("_rn", rank).where(F.col("_rn") == 1).drop("_hash", "_rn")


def answers_and_unique_prompts(
    df: DataFrame,
    answer: str,
    prompt: str,
    lang: str | Column,
    order: list[str],
    min_chars: int = MIN_SOURCE_CHARS,
) -> DataFrame:
    """All answers, and each distinct prompt once (its first occurrence)."""
    answers = unpivot_texts(df, {answer: lang}, min_chars)
    prompts = df.select("doc_id", *[c for c in order if c != "doc_id"], _lang(lang).alias("lang"), prompt)
    item = F.filter(F.array(py_strip(F.coalesce(F.col(prompt), F.lit("")))), lambda t: F.length(t) >= min_chars)
    prompts = prompts.select("doc_id", *[c for c in order if c != "doc_id"], "lang", F.explode(item).alias("text"))
    unique = keep_first_by_hash(prompts, "text", order)
    return answers.unionByName(unique.withColumn("part", F.lit(1)).select(*RECORD))


def cap_per_language(
    df: DataFrame, caps: Mapping[str, int], buckets: list[str], order: list[str]
) -> DataFrame:
    """The first texts of each language in ``caps``, up to its cap; languages without a cap stay whole."""
    if not caps:
        return df
    limits = df.sparkSession.createDataFrame(list(caps.items()), "lang string, max_rows long")
    return first_per_group(df, "lang", buckets, order, limits, costly=True)


def cut_at_marker(
    df: DataFrame,
    markers: Mapping[str, Iterable[str]],
    default: Iterable[str],
    min_chars: int = MIN_SOURCE_CHARS,
) -> DataFrame:
    """Cut each text before its first line that starts, after stripping, with a stop marker of its language.

    Too short texts go before and after the cut.  The marker table is a small
    literal (a dozen languages), so no join is needed.
    """
    table = F.create_map(
        *[x for lang, words in markers.items() for x in (F.lit(lang), F.array(*map(F.lit, words)))]
    )
    words = F.coalesce(F.try_element_at(table, F.col("lang")), F.array(*map(F.lit, default)))

    def cut(text: Column, words: Column) -> Column:
        lines = F.split(text, F.lit("\n"), -1)
        stops = F.transform(
            lines, lambda line: bind(py_strip(line), lambda s: F.exists(words, lambda w: F.startswith(s, w)))
        )
        where = F.array_position(stops, F.lit(True))
        before = F.array_join(F.slice(lines, F.lit(1), (where - 1).cast("int")), "\n")
        return F.when(where > 0, py_strip(before)).otherwise(text)

    def shortened(text: Column) -> Column:
        return F.when(F.length(text) >= min_chars, bind(words, lambda w: cut(text, w)))

    kept = F.filter(
        F.array(bind(py_strip(F.coalesce(F.col("text"), F.lit(""))), shortened)),
        lambda t: F.length(t) >= min_chars,
    )
    rest = [c for c in df.columns if c != "text"]
    return df.select(*rest, F.explode(kept).alias("text")).select(*df.columns)


def union_subsets(subsets: Iterable[DataFrame]) -> DataFrame:
    """All subsets, matched by column name."""
    return reduce(DataFrame.unionByName, subsets)
