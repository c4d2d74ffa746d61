"""Exact top-k by integer inner products with an impact-ordered, score-at-a-time index.

Components are quantised to whole numbers first (``floor(scale * x)``); scores are their inner products.  Rows are
dealt to blocks of about ``block_rows``; each block is an index of posting segments, built once and stored: for a dimension and
a quantised impact (a multiple of a step) the rows that have it.  A batch of queries takes the segments
in falling order of impact and adds query component times impact to its accumulators.  After a level the part of a
row that is not yet added is bounded by |query| * |rest of the row|.  Processing stops only when these bounds prove that
few rows can still be among the best; all of those are rescored exactly from the whole vectors.  If no proof comes, all levels
are processed and the possible rows are rescored just the same, so the result is exact in any case.

Every query block meets every row block once (a stated query set against all rows).  A task takes a run of row blocks one after the other
and keeps only the best ``k`` rows per query; the merge of the runs takes the first ``k``.

Defined cases: a vector that is null or holds null or non-finite components (also after scaling) takes no part; rows with components of
2^20 or more stay outside the segments and are always rescored, and products that doubles do not hold exactly are computed in whole
numbers of any size; a score beyond a long stops at its bounds; a zero vector takes part with score 0; a shorter vector counts as
padded with zeros; of repeated ids the row with the smallest vector counts; with fewer candidates than ``k`` all are
returned; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import stored
from textloom.llm.vector_blocks import BLOCK_QUERIES, BLOCK_ROWS, EXACT, LEAST, Best, block_index, matrix, padded, products, search_blocks, size_of, whole_type, whole_vectors

BATCH_QUERIES = 256
LEVELS = 12
BIG = float(1 << 20)
# a segment this full is added as a matrix, a thinner one by its postings
FULL = 0.02
# proofs are tried from this level on, counted in steps
PROOF = 4
# a proof is tried on so many queries of a batch first
TRIED = 16


class ImpactBlock:
    """Posting segments of one block of whole-number vectors, by falling impact."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, levels: int = LEVELS) -> None:
        self.vectors, self.ids = np.asarray(vectors, dtype=np.float64), ids
        self.loose = size_of(self.vectors) >= BIG
        rest = np.where(self.loose[:, None], 0, self.vectors)
        top = int(np.abs(rest).max(initial=0))
        self.step = max(1, -(-top // levels))
        self.level = np.rint(rest / self.step).astype(np.int64)
        self.heights = sorted({int(h) for h in np.unique(np.abs(self.level)) if h}, reverse=True)
        self.postings: list[list[tuple[int, int, np.ndarray]] | None] = []
        self.rest_square: list[np.ndarray | None] = []
        for height in self.heights:
            at = np.abs(self.level) == height
            if at.mean() > FULL:
                self.postings.append(None)
            else:
                thin = []
                for sign in (1, -1):
                    dims, rows = np.nonzero((self.level == sign * height).T)
                    cut = np.flatnonzero(np.diff(dims)) + 1
                    for part, first in zip(np.split(rows, cut), np.concatenate([[0], cut]), strict=True):
                        if len(part):
                            thin.append((int(dims[first]), sign * height * self.step, part))
                self.postings.append(thin)
            rest = np.where(at, rest - self.level * self.step, rest)
            self.rest_square.append((rest * rest).sum(axis=1) if height <= PROOF else None)
        self._ready()

    def _ready(self) -> None:
        """The segments as they are added, from what is stored; where some above ``PROOF`` are full, those are added as one matrix."""
        high = np.abs(self.level)
        full = lambda at: np.where(at, self.level.astype(np.float64) * self.step, 0)
        self.segments: list[tuple[int, np.ndarray | list[tuple[int, int, np.ndarray]]]] = []
        together = any(thin is None for height, thin in zip(self.heights, self.postings, strict=True) if height > PROOF)
        if together:
            self.segments.append((PROOF + 1, full(high > PROOF)))
        for height, thin in zip(self.heights, self.postings, strict=True):
            if height <= PROOF or not together:
                self.segments.append((height, full(high == height) if thin is None else thin))
        self.rest_norm = {h: np.sqrt(x.astype(np.float64)) for h, x in zip(self.heights, self.rest_square, strict=True) if x is not None}
        self.size = size_of(self.vectors)

    def __getstate__(self) -> dict[str, object]:
        """An index is stored in whole numbers of the smallest types, a few bytes for each component."""
        kept = {k: v for k, v in self.__dict__.items() if k not in ("segments", "rest_norm", "size")}
        kept["vectors"], kept["level"] = whole_type(self.vectors), whole_type(self.level)
        kept["postings"] = [thin and [(dim, value, whole_type(rows)) for dim, value, rows in thin] for thin in self.postings]
        kept["rest_square"] = [square if square is None else whole_type(square) for square in self.rest_square]
        return kept

    def __setstate__(self, kept: dict[str, object]) -> None:
        self.__dict__ |= kept | {"vectors": kept["vectors"].astype(np.float64)}
        self._ready()

    def possible(self, queries: np.ndarray, k: int, few: float, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows (by query) that can still be among the best ``k``, and a score that each query's best ``k`` reach, ``least`` or more.

        Processed until at most a share ``few`` is left.
        """
        n, dim = self.vectors.shape
        open_rows = np.ones((len(queries), n), dtype=bool)
        asked = size_of(queries).max(initial=0)
        most = asked * (self.size[~self.loose].max(initial=0) + self.step) * dim
        if k >= n - self.loose.sum() or asked >= BIG or most >= EXACT / 4:
            return open_rows, least
        # sums of whole numbers up to this are exact in floats
        kind = np.float32 if most < 1 << 23 else np.float64
        rows = queries.T.astype(kind)
        score = np.zeros((n, len(queries)), dtype=kind)
        length = np.sqrt((queries * queries).sum(axis=1))
        for height, segment in self.segments:
            if isinstance(segment, np.ndarray):
                score += segment.astype(kind) @ rows
            else:
                for d, value, at in segment:
                    score[at] += rows[d] * kind(value)
            if height > PROOF:
                continue  # no proof to expect yet
            norm = self.rest_norm[height]
            if height > self.heights[-1]:
                tried, _ = self._open(score[:, :TRIED], queries[:TRIED], length[:TRIED], norm, k, least[:TRIED])
                if tried.mean() > few:
                    continue
            open_rows, least = self._open(score, queries, length, norm, k, least)
            if open_rows.mean() <= few:
                break
        return open_rows, least

    def _open(self, score: np.ndarray, queries: np.ndarray, length: np.ndarray, norm: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``possible`` after some segments: no other row reaches the exact scores of the first ``k`` so far."""
        score = np.ascontiguousarray(score.T)
        if (least == LEAST).any():
            # loose rows prove nothing, and nothing is proved of them
            known = np.where(self.loose, -np.inf, score).astype(score.dtype) if self.loose.any() else score
            first = np.argpartition(known, score.shape[1] - k, axis=1)[:, -k:]
            exact = np.einsum("qkd,qd->qk", self.vectors[first], queries)
            least = np.maximum(least, exact.min(axis=1).astype(np.int64))
        slack = 1 + (np.abs(least.astype(np.float64)) + length * norm.max(initial=0)) * 16 * np.finfo(score.dtype).eps
        edge = (least - slack).astype(score.dtype)[:, None] - length.astype(score.dtype)[:, None] * norm.astype(score.dtype)[None, :]
        return self.loose[None, :] | (score >= edge), least

    def best(self, queries: np.ndarray, k: int, few: float = 0.05, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, row number, score) of the best ``k`` rows of each query, exact; of those that reach ``least`` if it is given."""
        who, rows, scores = [], [], []
        dim = max(queries.shape[1], self.vectors.shape[1])
        # a query may have dimensions that no row of the block has, and the other way round
        held, asked = padded(self.vectors, dim), padded(queries, dim)
        least = np.full(len(queries), LEAST) if least is None else least
        for start in range(0, len(queries), BATCH_QUERIES):
            batch = asked[start : start + BATCH_QUERIES]
            able, reach = self.possible(batch[:, : self.vectors.shape[1]], k, few, least[start : start + BATCH_QUERIES])
            if able.mean() > 2 * few or self.size.max(initial=0) * size_of(batch).max() * dim >= EXACT:
                whole = products(batch, held)
                if k < len(held):
                    reach = np.maximum(reach, np.partition(np.where(able, whole, LEAST), len(held) - k, axis=1)[:, len(held) - k])
                query, row = np.nonzero(able & (whole >= reach[:, None]))
                exact = whole[query, row]
            else:
                query, row = np.nonzero(able)
                exact = np.einsum("pd,pd->p", held[row], batch[query]).astype(np.int64)
                near = exact >= reach[query]
                query, row, exact = query[near], row[near], exact[near]
            order = np.lexsort((self.ids[row], ~exact, query))
            opens = np.searchsorted(query, np.arange(len(batch)))
            order = order[np.arange(len(order)) - opens[query[order]] < k]
            who.append(start + query[order])
            rows.append(row[order])
            scores.append(exact[order])
        return np.concatenate(who), np.concatenate(rows), np.concatenate(scores)


def _build(table: pa.Table) -> ImpactBlock:
    table = table.combine_chunks()
    return ImpactBlock(matrix(table.column("vector").combine_chunks()), table.column("vec_id").to_numpy())


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the exact ``k`` best other rows for each row chosen by ``is_query`` over ``vec_id``."""
    rows = stored(whole_vectors(vectors, scale), "impact-rows")
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    blocks = max(1, -(-sizes["n"] // block_rows))
    index = block_index(rows, blocks, _build, "impact-index")

    def answer(block: ImpactBlock, asked: pa.RecordBatch, so_far: pa.RecordBatch | None) -> pa.RecordBatch:
        names = asked.column("vec_id").to_numpy()
        least = np.full(len(names), LEAST)
        if so_far is not None:  # the last of k other rows; what does not reach it cannot be among the best
            place = np.argsort(names)
            of, first, count = np.unique(so_far.column("query_id").to_numpy(), return_index=True, return_counts=True)
            last = so_far.column("score").to_numpy()[first + count - 1]
            least[place[np.searchsorted(names[place], of[count == k])]] = last[count == k]
        who, found, score = block.best(matrix(asked.column("vector")), k + 1, least=least)
        other = names[who] != block.ids[found]
        columns = (names[who][other], block.ids[found][other], score[other])
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    asked = rows.where(is_query)
    best = Best(("query_id",), "score", "vec_id", k)
    parts = search_blocks(index, blocks, asked, "vec_id", sizes["q"], answer, "query_id long, vec_id long, score long", best, block_queries)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return parts.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(table: str, column: str, query: str, k: int = 20, scale: int = 64) -> str:
    return f"""
WITH v AS (SELECT vec_id, min(list_transform({column}, lambda x: floor({scale} * CAST(x AS DOUBLE)))) AS v FROM {table}
           WHERE vec_id IS NOT NULL AND {column} IS NOT NULL
             AND len(list_filter({column}, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE {query.format('q.vec_id')}),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}
"""
