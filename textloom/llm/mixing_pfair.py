"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Each source's documents form blocks of ``block_rows`` rows.  A source of weight w / W (W the sum of
the integer weights) may run its k-th block (k from 1) in the time slots from its release
``floor((k-1) * W / w)`` up to before its deadline ``ceil(k * W / w)``; every slot goes to the released block with the
earliest deadline (ties: larger weight, then name).  Up to any slot a source has then got its share
of the slots to within less than one block.

The windows repeat after W slots (less, if the weights have a common divisor), so the schedule of one period is enough: it is worked out once
for each set of weights, a table of W rows.  The slot of any block follows from its
period and its place in the period, by one join on that table.  Blocks are numbered with a two-level
count: rows are dealt to hash buckets of bounded size within their source, rows are
numbered within a bucket, and the counts of earlier buckets are added.  No source is handled by one task.

A source without a weight gets ``default_weight``; weights are positive integers.  When a source runs out,
its later slots stay empty; no row is dropped or repeated.  ``in_target`` marks the rows before the first
such slot, where the mix is exact.

Defined cases: a null source is a source of its own; repeated rows each have a place; rows with equal
``order_by`` values are told apart by their text; null texts and ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import by_place, pick, stored

BLOCK_ROWS = 64
BUCKET_ROWS = 4_000


EUCLID_STEPS = 48  # enough for any two integers of 31 bits


def _common_divisor(weights: Column) -> Column:
    """The greatest common divisor of an array of positive integers; 0 of an empty one."""

    def step(pair: Column, _: Column) -> Column:
        more = pair["b"] != 0
        left = F.when(more, pair["b"]).otherwise(pair["a"])
        return F.struct(left.alias("a"), F.when(more, pair["a"] % pair["b"]).otherwise(pair["b"]).alias("b"))

    def of_two(a: Column, b: Column) -> Column:
        start = F.struct(b.cast("long").alias("a"), a.alias("b"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(EUCLID_STEPS)), start, step, lambda pair: pair["a"])

    return F.aggregate(weights, F.lit(0).cast("long"), of_two)


def period_schedule(weights: DataFrame) -> DataFrame:
    """(name, k, slot, period) for the blocks of one period, from ``weights(name, weight)``.

    Weights count by their ratios, so they are divided by their greatest common divisor first: the schedule
    of the whole weights is that many repetitions of this one.  The work is W steps over the sources, W the sum of what is left: it
    depends on the weights alone.  The steps are taken in spans of about sqrt(W), so that no step copies a list longer than that.
    """
    total = weights.agg(
        F.sum("weight").cast("long").alias("whole"),
        F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("minus"), "name", "weight"))).alias("sources"),
    ).where("whole > 0")
    total = total.withColumn("divisor", _common_divisor(F.transform("sources", lambda s: s["weight"])))
    total = total.select("sources", "divisor", (F.col("whole") / F.col("divisor")).cast("long").alias("period"))
    total = total.withColumn("span", F.ceil(F.sqrt("period")).cast("long"))
    got = F.transform("sources", lambda s: F.lit(0).cast("long"))

    def step(state: Column, slot: Column) -> Column:
        # of the released blocks the one with the earliest deadline; sources stand in the order of ties
        number = F.sequence(F.lit(0), F.size("sources") - 1)

        def window(i: Column) -> Column:
            done, weight = F.get(state["got"], i), (F.get(F.col("sources"), i)["weight"] / F.col("divisor")).cast("long")
            release = F.floor(done * F.col("period") / weight)
            deadline = F.ceil((done + 1) * F.col("period") / weight)
            return F.struct((release > slot).alias("later"), deadline.alias("deadline"), i.alias("i"))

        best = F.array_min(F.transform(number, window))["i"]
        return F.struct(
            F.transform(state["got"], lambda g, i: F.when(i == best, g + 1).otherwise(g)).alias("got"),
            F.concat(state["picks"], F.array(best)).alias("picks"),
        )

    def span(state: Column, first: Column) -> Column:
        slots = F.sequence(first, F.least(first + F.col("span"), F.col("period")) - 1)
        begun = F.struct(state["got"].alias("got"), F.array().cast("array<int>").alias("picks"))
        done = F.aggregate(slots, begun, step)
        return F.transform(
            F.array(done),
            lambda d: F.struct(d["got"].alias("got"), F.concat(state["spans"], F.array(d["picks"])).alias("spans")),
        )[0]

    start = F.struct(got.alias("got"), F.array().cast("array<array<int>>").alias("spans"))
    firsts = F.sequence(F.lit(0).cast("long"), F.col("period") - 1, F.col("span"))
    picks = total.select(
        "period", "sources", F.posexplode(F.flatten(F.aggregate(firsts, start, span, lambda s: s["spans"]))).alias("slot", "pick")
    )
    named = picks.select("period", "slot", F.get(F.col("sources"), F.col("pick"))["name"].alias("name"))
    k = F.row_number().over(Window.partitionBy("name").orderBy("slot"))
    return named.select("name", k.alias("k"), F.col("slot").cast("long").alias("slot"), "period")


def mix_key(seed: int) -> Column:
    """The order of a source's documents: a hash of the seed, the id and the text."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text")]
    return F.md5(F.concat(F.lit(f"{seed}|"), text[0], F.lit("|"), text[1]))


def source_name() -> Column:
    """A name for every source, null too."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))


def with_numbers(rows: DataFrame, bucket_rows: int, seed: int) -> DataFrame:
    """``rows(doc_id, source, text, ...)`` with ``mix_name`` and ``mix_number``, a row's number in its source from 0."""
    keyed = rows.select("*", source_name().alias("mix_name"), mix_key(seed).alias("mix_key"))
    buckets = max(1, -(-rows.count() // bucket_rows))
    head = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("long")
    # rises with the key, so that numbers do not depend on how many buckets there are
    keyed = keyed.withColumn("mix_bucket", F.floor(head * buckets / float(1 << 32)))
    counts = keyed.groupBy("mix_name", "mix_bucket").agg(F.count("*").alias("mix_n"))
    before = Window.partitionBy("mix_name").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("mix_name", "mix_bucket", F.coalesce(F.sum("mix_n").over(before), F.lit(0)).alias("mix_before"))
    inside = F.row_number().over(Window.partitionBy("mix_name", "mix_bucket").orderBy("mix_key"))
    numbered = keyed.withColumn("mix_in", inside).join(earlier, ["mix_name", "mix_bucket"])
    return numbered.select(*rows.columns, "mix_name", (F.col("mix_before") + F.col("mix_in") - 1).alias("mix_number"))


def mix(
    docs: DataFrame,
    weights: DataFrame,
    block_rows: int = BLOCK_ROWS,
    bucket_rows: int = BUCKET_ROWS,
    default_weight: int = 1,
    seed: int = 42,
    carry: bool = False,
) -> DataFrame:
    """(doc_id, source, block, place, slot, in_target) for every row of ``docs``; with ``carry`` the rest as ``row``.

    ``weights(source, weight)``: integers above 0.  The mixed order is (slot, place).
    """
    placed, name_of = by_place(docs)
    rest = F.struct(*placed.columns) if carry else F.lit(None).cast("int")
    rows = placed.select(
        *[(F.col(n) if (n := name_of(c)) else F.lit(None)).cast(kind).alias(c) for c, kind in (("doc_id", "long"), ("source", "string"), ("text", "string"))],
        rest.alias("mix_row"),
    )
    given = pick(weights, source="string", weight="int").select(source_name().alias("name"), "weight")
    given = given.where("weight > 0").groupBy("name").agg(F.max("weight").alias("weight"))
    counts = rows.groupBy(source_name().alias("name")).agg(F.count("*").alias("n"))
    sources = counts.join(given, "name", "left").select(
        "name", "n", F.coalesce("weight", F.lit(default_weight)).alias("weight")
    )
    sources = stored(sources, "mix-sources")
    schedule = stored(period_schedule(sources), "mix-schedule")
    numbered = with_numbers(rows, bucket_rows, seed)
    block = F.floor(F.col("mix_number") / block_rows)
    placed = _slot_of(numbered.select("*", block.alias("block")), schedule)
    # the first slot without a full block of its source
    ends = _slot_of(sources.select(F.col("name").alias("mix_name"), F.floor(F.col("n") / block_rows).alias("block")), schedule)
    end = ends.agg(F.min("slot")).first()[0]
    return placed.select(
        "doc_id",
        "source",
        "block",
        (F.col("mix_number") % block_rows).alias("place"),
        "slot",
        (F.col("slot") < F.lit(end if end is not None else 0)).alias("in_target"),
        *[F.col("mix_row").alias("row")] * carry,
    )


def _slot_of(rows: DataFrame, schedule: DataFrame) -> DataFrame:
    """Adds ``slot`` to rows with ``mix_name`` and ``block``: whole periods, then the place in the period.

    The schedule holds one row per slot of a period: its size is that of the weights, not of the data.
    """
    # a source has as many blocks in a period as its reduced weight says
    share = schedule.groupBy(F.col("name").alias("mix_name")).agg(F.max("k").cast("long").alias("w"))
    near = rows.join(share, "mix_name").withColumn("k", (F.col("block") % F.col("w") + 1).cast("int"))
    named = schedule.select(F.col("name").alias("mix_name"), "k", F.col("slot").alias("first"), "period")
    slotted = near.join(named, ["mix_name", "k"])
    return slotted.withColumn("slot", F.floor(F.col("block") / F.col("w")) * F.col("period") + F.col("first")).drop(
        "w", "k", "first", "period"
    )


def mixed(docs: DataFrame, weights: DataFrame, **options: int) -> DataFrame:
    """``docs`` in mixed order: the rows sorted by their slot, with the columns of ``docs``."""
    placed = mix(docs, weights, carry=True, **options)
    return placed.orderBy("slot", "place", "doc_id").select("row.*").toDF(*docs.columns)


def weights_by_rule(docs: DataFrame, rule: Column) -> DataFrame:
    """Integer weights from an expression over ``source``, one per source of ``docs``."""
    return pick(docs, source="string").distinct().select("source", rule.cast("int").alias("weight"))


SQL = """
w AS (SELECT CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS name, count(*) AS n,
             max({weight}) AS weight FROM documents GROUP BY 1),
s AS (SELECT list(name ORDER BY weight DESC, name) AS names, list(weight ORDER BY weight DESC, name) AS ws,
             CAST(sum(weight) AS BIGINT) AS period FROM w),
r(slot, got, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(ws, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM s
  UNION ALL
  SELECT slot + 1, list_transform(got, lambda g, i: CASE WHEN i = best THEN g + 1 ELSE g END), best FROM (
    SELECT r.slot, r.got, list_sort(list_transform(range(1, len(got) + 1), lambda i:
      {{'later': (got[i] * period) // ws[i] > r.slot + 1, 'deadline': -((-(got[i] + 1) * period) // ws[i]), 'i': i}}))[1].i AS best
    FROM r, s WHERE r.slot + 1 < s.period)),
p AS (SELECT names[pick] AS name, r.slot, period,
             row_number() OVER (PARTITION BY names[pick] ORDER BY r.slot) AS k FROM r, s WHERE r.slot >= 0),
d AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS name,
             row_number() OVER (PARTITION BY source ORDER BY
               md5('{seed}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, ''))) - 1 AS number
      FROM documents),
e AS (SELECT min((n // {block} // weight) * period + p.slot) AS stop
      FROM w JOIN p ON p.name = w.name AND p.k = (n // {block}) % weight + 1)
SELECT doc_id, source, number // {block} AS block, number % {block} AS place,
       (number // {block} // weight) * period + p.slot AS slot,
       (number // {block} // weight) * period + p.slot < (SELECT stop FROM e) AS in_target
FROM d JOIN w ON w.name = d.name JOIN p ON p.name = d.name AND p.k = (number // {block}) % weight + 1
"""


def oracle(weight: str, block_rows: int = BLOCK_ROWS, seed: int = 42) -> str:
    """The SQL counterpart of ``mix`` for a weight expression over ``source``."""
    return "WITH RECURSIVE " + SQL.format(weight=weight, block=block_rows, seed=seed).strip()
