"""Global order without a single task: buckets, prefix sums and exact cuts.

All operators here work on *buckets*: columns that are monotone in the wanted
order.  Work inside a bucket is local to it; between buckets only one summary
row each is exchanged.  The bucket expression is deterministic, so several passes
(and retried tasks) agree on it.

Order columns identify a row, and neither they nor the buckets are null.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.session import settle

BEFORE = (Window.unboundedPreceding, -1)
# rows of a level of sums over sums; the driver holds one level at most
FANOUT = 10_000
BROADCAST_ROWS = 100_000
ROWS_PER_BUCKET, MAX_BUCKETS = 250_000, 20_000


def range_bucket(df: DataFrame, key: str, out: str, buckets: int | None = None) -> DataFrame:
    """Add ``out``: the number of the key range a row falls in, ranges holding similar row counts.

    The bounds are approximate quantiles of the (narrow) key column, so clustered
    keys still give even buckets.  Their number grows with the table, as a bucket is
    sorted by one task, up to what the driver easily holds.
    """
    if buckets is None:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(least, min(MAX_BUCKETS, df.select(key).count() // ROWS_PER_BUCKET))
    steps = [i / buckets for i in range(1, buckets)]
    number = F.col(key).cast("double").alias(out + "_key")
    bounds = df.select(number).approxQuantile(out + "_key", steps, 0.25 / buckets) if steps else []
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    if len(splits) == 2:
        return df.withColumn(out, F.lit(0))
    bucketizer = Bucketizer(splits=splits, inputCol=out + "_key", outputCol=out)
    placed = bucketizer.transform(df.withColumn(out + "_key", F.col(key).cast("double")))
    return placed.withColumn(out, F.col(out).cast("int")).drop(out + "_key")


def seeded_hash(seed: int, *keys: str) -> Column:
    """Order key of a reproducible shuffle: independent of partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def hash_bucket(digest: Column, hex_digits: int) -> Column:
    """Bucket of an md5 digest, monotone in the digest and evenly filled."""
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("int")


def in_groups(rows: DataFrame, keys: list[str], count: int | None = None) -> tuple[DataFrame, int]:
    """``rows``, computed once (before, if their ``count`` is given), with ``_group``: consecutive ranges of at most about ``FANOUT`` rows in the order of ``keys``.

    For summaries of buckets, whose keys are unique.  What is left to exchange between groups is one
    row each; with ``FANOUT`` groups of that size they cover 10^8 buckets.
    """
    settled = rows.withColumn("_group", F.lit(0))
    if count is None:
        settled, count = settle(settled)
    groups = max(1, -(-count // FANOUT))
    if groups > 1:
        settled, _ = settle(settled.repartitionByRange(groups, *keys).withColumn("_group", F.spark_partition_id()))
    return settled, groups


def by_keys(keys: list[str]) -> Callable[[Row], tuple]:
    """Sorts collected rows as Spark does: nulls first."""
    return lambda row: tuple((row[k] is not None, row[k] if row[k] is not None else 0) for k in keys)


def running_totals(totals: DataFrame, keys: list[str], sums: list[str], count: int | None = None) -> DataFrame:
    """``keys`` and, as ``_offset_<name>``, the sums of the rows before, for a table with unique keys.

    Sums over sums: rows are summed within groups of ``FANOUT``, and the totals of the groups the same way, until
    so few are left that the driver adds them up.  No window covers the table.
    """
    placed, groups = in_groups(totals.select(*keys, *sums), keys, count)
    if groups == 1:
        table = placed.drop("_group").toArrow()  # FANOUT rows at most
        table = table.take(pc.sort_indices(table, [(k, "ascending") for k in keys], null_placement="at_start"))
        columns = [table.column(k) for k in keys]
        for name in sums:
            own = pc.fill_null(table.column(name).cast("int64"), 0)
            columns.append(pc.subtract(pc.cumulative_sum(own), own))
        made = pa.table(columns, [*keys, *[f"_offset_{name}" for name in sums]])
        kinds = [T.StructField(k, totals.schema[k].dataType) for k in keys]
        kinds += [T.StructField(f"_offset_{name}", T.LongType()) for name in sums]
        return totals.sparkSession.createDataFrame(made, T.StructType(kinds))
    upper = placed.groupBy(F.col("_group").alias("_range")).agg(*[F.sum(name).alias(name) for name in sums])
    above = running_totals(upper, ["_range"], sums).withColumnRenamed("_range", "_group")
    inside = Window.partitionBy("_group").orderBy(*keys).rowsBetween(*BEFORE)
    local = placed.select(*keys, "_group", *[F.coalesce(F.sum(name).over(inside), F.lit(0)).alias(f"_in_{name}") for name in sums])
    offsets = [(F.col(f"_offset_{name}") + F.col(f"_in_{name}")).cast("long").alias(f"_offset_{name}") for name in sums]
    return local.join(F.broadcast(above) if groups <= FANOUT else above, "_group").select(*keys, *offsets)


def exclusive_prefix(
    df: DataFrame, buckets: list[str], order: list[str], sums: dict[str, Column], measured: DataFrame | None = None
) -> DataFrame:
    """For each output name, the sum of its expression over all rows before this one.

    Rows are ordered by ``buckets``, then ``order``.  One shuffle by bucket; the
    totals of earlier buckets come from a table with one row per bucket, joined
    on the partitioning the window already has (or broadcast, if small).  That table is
    computed here and now, from ``measured(*buckets, *sums)`` if the sums are cheaper to get without ``df``.
    """
    if measured is None:
        measured = df.select(*buckets, *[expr.alias(name) for name, expr in sums.items()])
    totals = measured.groupBy(*buckets).agg(*[F.sum(name).cast("long").alias(name) for name in sums])
    offsets = running_totals(totals, buckets, list(sums))
    inside = Window.partitionBy(*buckets).orderBy(*order).rowsBetween(*BEFORE)
    local = df.select(
        "*",
        *[F.coalesce(F.sum(expr).over(inside), F.lit(0)).alias(f"_local_{name}") for name, expr in sums.items()],
    )
    joined = local.join(offsets, buckets)
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_offset_{name}") + F.col(f"_local_{name}")).cast("long").alias(name)
            for name in sums
        ],
    )


def dense_index(df: DataFrame, buckets: list[str], order: list[str], out: str) -> DataFrame:
    """A gap-free 0-based row number in global order."""
    return exclusive_prefix(df, buckets, order, {out: F.lit(1)})


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df``, computed once, with a broadcast hint only if its counted size allows it."""
    settled, rows = settle(df)
    return F.broadcast(settled) if rows <= BROADCAST_ROWS else settled


def join_small(df: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a side that is expected to be small: broadcast it only if its counted size allows.

    Above the bound the join is a normal shuffle join, where adaptive execution
    splits skewed keys.
    """
    return df.join(broadcast_if_small(small), on, how)


def first_per_group(
    df: DataFrame,
    group: str,
    buckets: list[str],
    order: list[str],
    limits: DataFrame,
    costly: bool = False,
) -> DataFrame:
    """The first ``max_rows`` rows of each group, exactly, without moving the rows themselves.

    ``limits(group, max_rows)``: null or no row means all rows.  Counts per bucket
    find the bucket where a group's limit falls; only the keys of that bucket are
    ranked, which gives the group's last key; the rows are then filtered in place.
    The keys are read twice before that: set ``costly`` to store them once if
    computing the rows takes much more than a scan.
    """
    keys = [group, *buckets]
    key_rows = df.select(*dict.fromkeys([*keys, *order]))
    if costly:
        key_rows, _ = settle(key_rows)
    counts, many = settle(key_rows.groupBy(*keys).agg(F.count("*").alias("_n")))
    # running counts of the whole table, less those before the group
    offsets = running_totals(counts, keys, ["_n"], many)
    of_group = offsets.groupBy(group).agg(F.min("_offset__n").alias("_start")).join(
        counts.groupBy(group).agg(F.sum("_n").alias("_all")), group
    )
    running = counts.join(offsets, keys).join(of_group, group)
    running = running.select(*keys, "_n", (F.col("_offset__n") - F.col("_start")).alias("_before"), "_all")
    beyond = running.join(limits, group).where(F.col("max_rows") < F.col("_all"))
    before, limit = F.col("_before"), F.col("max_rows")
    # one row per limited group: where its limit falls; a limit of zero falls before the first bucket
    reached, rows = settle(
        beyond.where(((before < limit) & (limit <= before + F.col("_n"))) | ((limit <= 0) & (before == 0)))
        .select(*keys, (limit - before).alias("_rank"))
    )
    # the table of last keys below is no longer than this one
    hint = F.broadcast if rows <= BROADCAST_ROWS else (lambda small: small)
    ranked = key_rows.join(hint(reached), keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    # buckets are monotone in the order, so (buckets, order) compares like the order
    place = list(dict.fromkeys([*buckets, *order]))
    last = (
        ranked.withColumn("_rn", rank)
        .where(F.col("_rn") == F.col("_rank"))
        .select(group, F.struct(*place).alias("_last"))
    )
    cuts = reached.select(group).join(last, group, "left").withColumn("_cut", F.lit(True))
    keep = F.col("_cut").isNull() | (F.struct(*place) <= F.col("_last"))
    return df.join(hint(cuts), group, "left").where(keep).select(*df.columns)
