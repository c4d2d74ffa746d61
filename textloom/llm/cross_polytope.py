"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables.

A pseudo-rotation is three rounds of random signs and a fast Hadamard transform; a unit vector falls to
the signed axis nearest to its rotation.  A table joins ``hashes`` such axes into one bucket.  A query looks into the
``probes`` buckets of each table whose axes fit it best; every row found there is compared by its
exact inner product in double precision on the original vectors.

For inner products of vectors of any length, vectors get one more component sqrt(M^2 - |x|^2) before hashing (M the
largest length), queries a zero: the angle then orders rows as the inner product does.

Equal vectors are one entry with the ``k + 1`` smallest ids, so copies neither fill buckets nor repeat work.
Rows are hashed once and stored.  A bucket is cut into parts of about ``part_rows`` entries, and a
query visits every part of its buckets; each part returns its best ``k`` per query.

Defined cases: a vector that is null, zero, or holds null or non-finite components takes no part; a shorter
vector counts as padded with zeros; equal scores go by id; of repeated ids the row with the smallest vector counts; with fewer candidates than ``k`` all found are returned; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import pick, stored

TABLES = 12
PROBES = 12
PART_ROWS = 4096
RESULT = "query_id long, rank int, vec_id long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row (length a power of two), scaled to keep lengths."""
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, -1, 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / math.sqrt(width)


class CrossPolytope:
    """The hash functions: ``tables`` x ``hashes`` pseudo-rotations of vectors padded to a power of two."""

    def __init__(self, dim: int, tables: int, hashes: int, seed: int) -> None:
        self.width = 1 << max(1, (dim - 1).bit_length())
        self.tables, self.hashes = tables, hashes
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(tables, hashes, 3, self.width))

    def fits(self, x: np.ndarray, table: int, number: int) -> np.ndarray:
        """Inner products with all signed axes, after the rotation: columns are +axes, then -axes."""
        padded = np.zeros((len(x), self.width))
        padded[:, : x.shape[1]] = x
        for signs in self.signs[table, number]:
            padded = hadamard(padded * signs)
        return np.hstack([padded, -padded])

    def buckets(self, x: np.ndarray, table: int) -> np.ndarray:
        code = np.zeros(len(x), dtype=np.int64)
        for number in range(self.hashes):
            code = code * (2 * self.width) + np.argmax(self.fits(x, table, number), axis=1)
        return code

    def probes(self, x: np.ndarray, table: int, probes: int) -> np.ndarray:
        """The ``probes`` best buckets of each row, best first: axes are combined by the sum of their fits."""
        axes = 2 * self.width
        keep = min(axes, probes)
        codes, total = np.zeros((len(x), 1), dtype=np.int64), np.zeros((len(x), 1))
        for number in range(self.hashes):
            fit = self.fits(x, table, number)
            best = np.argsort(-fit, axis=1, kind="stable")[:, :keep]
            value = np.take_along_axis(fit, best, axis=1)
            codes = (codes[:, :, None] * axes + best[:, None, :]).reshape(len(x), -1)
            total = (total[:, :, None] + value[:, None, :]).reshape(len(x), -1)
            order = np.argsort(-total, axis=1, kind="stable")[:, :probes]
            codes, total = np.take_along_axis(codes, order, axis=1), np.take_along_axis(total, order, axis=1)
        return codes


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the vectors that take part, components as doubles."""
    rows = pick(vectors, vec_id="long", vector="array<double>").where("vec_id is not null and vector is not null")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    rows = rows.where(F.forall("vector", finite) & F.exists("vector", lambda v: v != 0))
    dim = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    missing = F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("vector"))
    return rows.withColumn("vector", F.when(F.size("vector") < dim, F.concat("vector", missing)).otherwise(F.col("vector")))


def nearest(
    vectors: DataFrame,
    is_query: F.Column,
    k: int = 20,
    tables: int = TABLES,
    probes: int = PROBES,
    hashes: int = 1,
    part_rows: int = PART_ROWS,
    seed: int = 11,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query (``is_query`` over ``vec_id``) the ``k`` nearest other rows found.

    ``vectors(vec_id, vector)``.  ``hashes`` is the number of axes a bucket joins: one suits up to some
    million distinct vectors, two a hundred times as many with more probes.
    """
    rows = usable(vectors)
    # minus zero is zero; a repeated id is one row
    rows = rows.withColumn("vector", F.transform("vector", lambda v: v + F.lit(0.0)))
    rows = stored(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")), "ann-rows")
    # equal vectors share an entry, named by the smallest id; the row limit applies before the shuffle
    ordered = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("rn", F.row_number().over(ordered)).where(F.col("rn") <= k + 1)
    entries = few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    entries = stored(entries.select(F.col("ids")[0].alias("entry"), "vector", "ids"), "ann-entries")
    square = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v)
    shape = entries.agg(F.max(F.size("vector")).alias("dim"), F.max(square).alias("high"), F.min(square).alias("low")).first()
    dim, longest = shape["dim"] or 1, shape["high"] or 1.0
    same_length = longest - (shape["low"] or longest) <= 1e-4 * longest  # unit vectors need no further component
    wanted = rows.where(is_query).join(entries.select("vector", "entry"), "vector").select("vec_id", "entry")
    asked = entries.join(wanted.select("entry").distinct(), "entry", "left_semi").select("entry", "vector")

    def unit(x: np.ndarray, query: bool) -> np.ndarray:
        if not same_length:
            last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, longest - (x * x).sum(axis=1)))
            x = np.hstack([x, last[:, None]])
        return x / math.sqrt(longest)

    shipped = rows.sparkSession.sparkContext.broadcast(CrossPolytope(dim + (not same_length), tables, hashes, seed))

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)

    def place(query: bool):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            functions = shipped.value
            for batch in batches:
                x = unit(matrix(batch.column("vector")), query)
                found = [
                    functions.probes(x, t, probes) if query else functions.buckets(x, t)[:, None] for t in range(tables)
                ]
                size = (2 * functions.width) ** hashes
                codes = np.hstack([f + t * size for t, f in enumerate(found)])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1, dtype=np.int32) * codes.shape[1]), pa.array(codes.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays([batch.column("entry"), batch.column("vector"), lists], ["entry", "vector", "codes"])

        return run

    kinds = "entry long, vector array<double>, codes array<long>"
    index = stored(entries.select("entry", "vector").mapInArrow(place(False), kinds), "ann-index")
    coded = index.select("entry", "vector", F.explode("codes").alias("code"))
    sizes = index.select(F.explode("codes").alias("code")).groupBy("code").agg(
        F.ceil(F.count("*") / part_rows).cast("int").alias("parts")
    )
    sizes = stored(sizes, "ann-buckets")
    left = coded.join(sizes, "code").select(
        "code", F.pmod(F.hash("entry"), "parts").alias("part"), F.lit(False).alias("query"), "entry", "vector"
    )
    right = (
        asked.mapInArrow(place(True), kinds)
        .select("entry", "vector", F.explode("codes").alias("code"))
        .join(sizes, "code")
        .select("code", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("query"), "entry", "vector")
    )
    met = left.union(right).repartition("code", "part").sortWithinPartitions("code", "part", "query", "entry")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, names, held = None, [], []  # the entries of one part of a bucket, at most about ``part_rows``
        block = None

        def best(asking: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            ids, y = block
            score = x @ y.T
            count = min(k + 1, len(ids))
            edge = -np.partition(-score, count - 1, axis=1)[:, count - 1]
            found, exact, sizes = [], [], []
            for i in range(len(x)):
                # all that may tie with the last one; sums of single rows do not depend on their neighbours in the block
                near = np.flatnonzero(score[i] >= edge[i] - 1e-10 * longest)
                value = (y[near] * x[i]).sum(axis=1)
                order = np.lexsort((ids[near], -value))[:count]
                found.append(ids[near[order]])
                exact.append(value[order])
                sizes.append(len(order))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(asking),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(exact))),
                ],
                ["query", "entries", "scores"],
            )

        for batch in batches:
            code, part = (batch.column(c).to_numpy() for c in ("code", "part"))
            asks = batch.column("query").to_numpy(zero_copy_only=False)
            ids, x = batch.column("entry").to_numpy(), matrix(batch.column("vector"))
            change = np.flatnonzero((np.diff(code) != 0) | (np.diff(part) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for low, high in zip([0, *change], [*change, len(ids)], strict=True):
                place_now = (code[low], part[low])
                if place_now != here:
                    here, names, held, block = place_now, [], [], None
                if not asks[low]:
                    names.append(ids[low:high])
                    held.append(x[low:high])
                elif held or block is not None:
                    if block is None:
                        block = (np.concatenate(names), np.concatenate(held))
                        names, held = [], []
                    for at in range(low, high, 1024):
                        until = min(high, at + 1024)
                        yield best(ids[at:until], x[at:until])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best k + 1 entries of each query, from its parts, which arrive one after another."""
        here, ids, scores, out = None, [], [], []

        def close() -> None:
            entry, first = np.unique(np.concatenate(ids), return_index=True)
            score = np.concatenate(scores)[first]
            top = np.lexsort((entry, -score))[: k + 1]
            out.extend((here, int(e), float(v)) for e, v in zip(entry[top], score[top], strict=True))

        for batch in batches:
            names = batch.column("query").to_pylist()
            for i, name in enumerate(names):
                if name != here:
                    if ids:
                        close()
                    here, ids, scores = name, [], []
                ids.append(batch.column("entries")[i].values.to_numpy())
                scores.append(batch.column("scores")[i].values.to_numpy())
                if len(ids) > 64:  # whatever the number of parts, only the best of them are held
                    entry, first = np.unique(np.concatenate(ids), return_index=True)
                    score = np.concatenate(scores)[first]
                    top = np.lexsort((entry, -score))[: k + 1]
                    ids, scores = [entry[top]], [score[top]]
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("query", "entry", "score"), r, strict=True)) for r in out])
                out = []
        if ids:
            close()
            yield pa.RecordBatch.from_pylist([dict(zip(("query", "entry", "score"), r, strict=True)) for r in out])

    # one row per query and part, with up to k + 1 entries (the query's own among them)
    parts = met.mapInArrow(compare, "query long, entries array<long>, scores array<double>")
    found = parts.repartition("query").sortWithinPartitions("query").mapInArrow(merge, "query long, entry long, score double")
    answers = found.join(entries.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    per_entry = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    # k + 1 rows serve every query of an entry: at most one of them is the query itself
    lists = answers.withColumn("rn", F.row_number().over(per_entry)).where(F.col("rn") <= k + 1)
    lists = lists.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rn", "vec_id", "score"))).alias("list"))
    others = wanted.join(lists, wanted["entry"] == lists["query"]).select(
        F.col("vec_id").alias("query_id"), F.filter("list", lambda r: r["vec_id"] != F.col("vec_id")).alias("list")
    )
    return others.select("query_id", F.posexplode(F.slice("list", 1, k)).alias("place", "r")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("r.vec_id").alias("vec_id"), F.col("r.score").alias("score")
    )
