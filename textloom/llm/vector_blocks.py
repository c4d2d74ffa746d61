"""Whole-number vectors in blocks: an index per block, built once, stored, and searched by blocks of queries."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from itertools import groupby, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import pick, stored

BLOCK_ROWS = 4096
BLOCK_QUERIES = 4096
RUN_BLOCKS = 16
PIECE_BYTES = 8192
EXACT = 2.0**53
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def whole_vectors(vectors: DataFrame, scale: int, **extra: str) -> DataFrame:
    """(vec_id, vector, ...): ``floor(scale * x)`` of each component as a double, one row per id.

    Rows without id, without vector or with a component that is null or not finite (also after scaling) are left out; of
    repeated ids the smallest vector counts.
    """
    rows = pick(vectors, vec_id="long", vector="array<double>", **extra).where("vec_id is not null and vector is not null")
    rows = rows.where(F.forall("vector", lambda v: v.isNotNull() & (F.abs(v * scale) < F.lit(float("inf")))))

    def floor(v: Column) -> Column:  # from 2^53 on all doubles are whole
        y = v * scale
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    whole = rows.select("vec_id", F.struct(F.transform("vector", floor).alias("vector"), *extra).alias("row"))
    return whole.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of an Arrow column as rows; shorter ones are padded with zeros."""
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    dim = max(1, int(lengths.max(initial=0)))
    out = np.zeros((len(column), dim))
    out[np.arange(dim)[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def padded(a: np.ndarray, dim: int) -> np.ndarray:
    return a if a.shape[1] >= dim else np.pad(a, ((0, 0), (0, dim - a.shape[1])))


def size_of(a: np.ndarray) -> np.ndarray:
    return np.abs(a).max(axis=1, initial=0)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of whole-number rows, exact; beyond a long they stop at its bounds."""
    dim = max(a.shape[1], b.shape[1])
    a, b = padded(a, dim), padded(b, dim)
    of_a, of_b = size_of(a), size_of(b)
    if of_a.max(initial=0) * of_b.max(initial=0) * dim < EXACT:
        return (a @ b.T).astype(np.int64)
    out = np.empty((len(a), len(b)), dtype=np.int64)
    edge = (EXACT / dim) ** 0.5 / 2
    big_a, big_b = of_a > edge, of_b > edge
    if not big_a.all() and not big_b.all():
        out[np.ix_(~big_a, ~big_b)] = (a[~big_a] @ b[~big_b].T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)
    for rows, columns in ((big_a, np.ones(len(b), dtype=bool)), (~big_a, big_b)):
        if rows.any() and columns.any():
            exact = whole(a[rows]) @ whole(b[columns]).T
            out[np.ix_(rows, columns)] = [[min(max(v, LEAST), MOST) for v in row] for row in exact]
    return out


def first_of_each(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` of every row by falling score, ties by id; ``score`` may hold ``LEAST`` for nothing."""
    order = np.lexsort((ids, ~score), axis=-1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


def whole_type(a: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them all; unchanged where only doubles do."""
    most = np.abs(a).max(initial=0)
    for kind in (np.int8, np.int16, np.int32):
        if most <= np.iinfo(kind).max:
            return a.astype(kind)
    return a


def block_index(rows: DataFrame, blocks: int, build: Callable[[pa.Table], object], name: str) -> DataFrame:
    """(block, piece, index): what ``build`` makes of the rows of each of ``blocks`` blocks, stored.

    It lies there in pieces of ``PIECE_BYTES``, as Spark's readers hold thousands of rows at once, whatever their size.
    """

    def make(table: pa.Table) -> pa.Table:
        made = zlib.compress(pickle.dumps(build(table), protocol=5), 1)
        pieces = [made[i : i + PIECE_BYTES] for i in range(0, len(made), PIECE_BYTES)]
        block = np.full(len(pieces), table.column("block")[0].as_py())
        return pa.table({"block": block, "piece": np.arange(len(pieces), dtype=np.int32), "index": pa.array(pieces, pa.binary())})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    return stored(dealt.groupBy("block").applyInArrow(make, "block long, piece int, index binary"), name)


class Best(NamedTuple):
    """The first ``k`` rows for each value of ``keys``, in the order of ``keys``: by falling ``score``, ties by ``row``."""

    keys: tuple[str, ...]
    score: str
    row: str
    k: int

    def of(self, found: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(found).combine_chunks()
        if not table.num_rows:
            return found[0]
        column = lambda name: table.column(name).to_numpy()
        order = np.lexsort((column(self.row), ~column(self.score), *[column(c) for c in reversed(self.keys)]))
        opens = np.ones(len(order), dtype=bool)
        opens[1:] = np.any([np.diff(column(c)[order]) != 0 for c in self.keys], axis=0)
        place = np.arange(len(order)) - np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))
        return table.take(pa.array(order[place < self.k])).combine_chunks().to_batches()[0]


def search_blocks(
    index: DataFrame,
    blocks: int,
    queries: DataFrame,
    key: str,
    n_queries: int,
    answer: Callable[[object, pa.RecordBatch, pa.RecordBatch | None], pa.RecordBatch],
    schema: str,
    best: Best,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``answer(index, some queries, best rows so far)`` for every block of the index and all queries; of it each task keeps the ``best``.

    A task holds a part of about ``block_queries`` queries, one index at a time, and the best rows so far; it meets a run of
    ``RUN_BLOCKS`` blocks, or of fewer while there are not enough tasks.
    """
    parts = max(1, -(-n_queries // block_queries))
    slots = index.sparkSession.sparkContext.defaultParallelism
    runs = min(blocks, max(-(-blocks // RUN_BLOCKS), -(-4 * slots // parts)))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    empty = [F.lit(None).cast(f.dataType).alias(f"q_{f.name}") for f in queries.schema.fields]
    held = index.select(F.pmod("block", F.lit(runs)).alias("run"), each(parts).alias("part"), "block", "piece", "index", *empty)
    asked = queries.select(
        each(runs).alias("run"),
        F.pmod(F.xxhash64(key), F.lit(parts)).alias("part"),
        F.lit(-1).cast("long").alias("block"),  # before all blocks
        F.lit(0).alias("piece"),
        F.lit(None).cast("binary").alias("index"),
        *[F.col(c).alias(f"q_{c}") for c in queries.columns],
    )
    task = (F.col("run") * parts + F.col("part")).cast("int")
    met = held.union(asked).repartitionById(runs * parts, task).sortWithinPartitions("block", "piece")
    names = queries.columns

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for low, high in pairwise(cuts):
                if low < high:
                    yield int(block[low]), batch.slice(low, high - low)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, found = None, None
        for block, rows in groupby(spans(batches), key=lambda span: span[0]):
            if block < 0:
                own = [pa.RecordBatch.from_arrays([span.column(f"q_{c}") for c in names], names) for _, span in rows]
                here = pa.Table.from_batches(own).combine_chunks().to_batches()[0]
            elif here is not None:
                pieces = [piece for _, span in rows for piece in span.column("index").to_pylist()]
                new = answer(pickle.loads(zlib.decompress(b"".join(pieces))), here, found)
                found = best.of([new] if found is None else [found, new])
        if found is not None:
            yield found

    return met.mapInArrow(search, schema)
