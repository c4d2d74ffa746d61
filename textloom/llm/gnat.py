"""Hard negatives by windows of similarity, with GNAT trees: multiway hyperplane trees with distance ranges.

Components are quantised to whole numbers first; a score is the integer inner product with an anchor.  An anchor's positives are
its best rows of the same label; its negatives for a positive are the best rows of other labels whose score lies within a window
of shares of the positive's score.

Rows are dealt to blocks of bounded size, and each block becomes one tree, built once and stored.  A node picks far-apart split
points among its rows and deals each row to the nearest one, so the branches lie between the hyperplanes of
the points.  For every split point and every branch, its own and those of its siblings, the node keeps the range of
distances from the point to the branch's rows.  The window of scores is an annulus of distances around an anchor,
``d^2 = |a|^2 + |x|^2 - 2 score``; the triangle inequality turns an anchor's distances to the split points and the ranges into
bounds for every branch, and a branch whose bounds miss the annulus, or cannot reach the best rows found so far, is
eliminated without a look at its rows.  The rows of the leaves that remain are compared exactly.  Anchors go through a
tree together, each through its own branches.

First all blocks return their best positives, Spark ranks them per anchor, and then all blocks are searched with the windows.
The anchors are a stated query set, compared with all rows in blocks.

Defined cases: a row with a null label, id or vector, or with a null or non-finite component, takes no part; rows with components of
2^20 or more after quantising stay outside the trees in a list that is always compared, in whole-number arithmetic; a score beyond
a long stops at its bounds; a shorter vector counts as padded with zeros; of repeated ids the smallest (vector, label) counts;
an anchor without positives, or a positive of negative score, has no negatives; equal scores go by id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import stored
from textloom.llm.vector_blocks import BLOCK_QUERIES, BLOCK_ROWS, LEAST, Best, block_index, first_of_each, matrix, padded, products, search_blocks, size_of, whole_vectors

LEAF_ROWS = 64
BRANCHES = 12
BIG = float(1 << 20)
MARGIN = 1e-7


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


class Node:
    """A leaf with its rows, or split points with a child for each and the distance ranges of all to all."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.children: list[Node] = []


class GnatBlock:
    """The tree of one block of rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF_ROWS, branches: int = BRANCHES) -> None:
        order = np.argsort(ids)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.loose = size_of(self.vectors) >= BIG
        self.norm = np.where(self.loose, 0, np.sqrt((np.where(self.loose[:, None], 0, self.vectors) ** 2).sum(axis=1)))
        self.leaf, self.branches = leaf, branches
        self.random = np.random.default_rng(len(ids))
        self.root = Node(np.flatnonzero(~self.loose))
        todo = [self.root]
        while todo:
            todo += self._split(todo.pop())
        del self.random

    def _split(self, node: Node) -> list[Node]:
        rows = node.rows
        if len(rows) <= self.leaf:
            return []
        # far-apart points from a few candidates, one after the other
        some = rows[self.random.permutation(len(rows))[: 4 * self.branches]]
        between = _distances(self.vectors[some], self.vectors[some])
        chosen, near = [0], between[0]
        while len(chosen) < self.branches:
            far = int(near.argmax())
            if near[far] <= 0:
                break
            chosen.append(far)
            near = np.minimum(near, between[far])
        points = some[chosen]
        apart = _distances(self.vectors[rows], self.vectors[points])
        branch = apart.argmin(axis=1)
        used = np.unique(branch)
        if len(used) < 2:
            return []
        node.points = self.vectors[points]
        node.children = [Node(rows[branch == j]) for j in used]
        node.low = np.stack([apart[branch == j].min(axis=0) for j in used], axis=1)  # point, branch
        node.high = np.stack([apart[branch == j].max(axis=0) for j in used], axis=1)
        node.least = np.array([self.norm[c.rows].min() for c in node.children])
        node.most = np.array([self.norm[c.rows].max() for c in node.children])
        return node.children

    def search(self, anchors: np.ndarray, may: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(scores, ids, compared): the first ``k`` rows in each window ``low[i, w] <= score <= high[i, w]`` of each anchor.

        ``may`` says which rows each anchor takes.  Where there are fewer, scores are ``LEAST``.
        """
        dim = max(anchors.shape[1], self.vectors.shape[1])
        anchors, vectors = padded(anchors, dim), padded(self.vectors, dim)
        n, windows = low.shape
        best = np.full((n, windows, k), LEAST, dtype=np.int64)
        ids = np.full((n, windows, k), np.iinfo(np.int64).max, dtype=np.int64)
        compared = 0

        def compare(who: np.ndarray, rows: np.ndarray) -> None:
            nonlocal compared
            compared += len(who) * len(rows)
            score = products(anchors[who], vectors[rows])
            able = may[np.ix_(who, rows)]
            for w in range(windows):
                fits = able & (score >= low[who, w, None]) & (score <= high[who, w, None]) & (score >= best[who, w, -1:])
                some = np.flatnonzero(fits.any(axis=1))
                if len(some):
                    mine = who[some]
                    both = np.concatenate([best[mine, w], np.where(fits[some], score[some], LEAST)], axis=1)
                    names = np.concatenate([ids[mine, w], np.where(fits[some], self.ids[rows], np.iinfo(np.int64).max)], axis=1)
                    best[mine, w], ids[mine, w] = first_of_each(both, names, k)

        everyone = np.arange(n)
        if self.loose.any():
            compare(everyone, np.flatnonzero(self.loose))
        big = size_of(anchors) >= BIG
        if big.any():
            compare(np.flatnonzero(big), np.flatnonzero(~self.loose))
        length = np.where(big, 0, np.sqrt((np.where(big[:, None], 0, anchors) ** 2).sum(axis=1)))

        def visit(node: Node, who: np.ndarray) -> None:
            if not node.children:
                if len(node.rows):
                    compare(who, node.rows)
                return
            apart = _distances(anchors[who], padded(node.points, dim))[:, :, None]
            slack = MARGIN * (1 + length[who, None] + node.most[None, :])
            nearest = np.maximum(apart - node.high, node.low - apart).max(axis=1) - slack
            farthest = (apart + node.high).min(axis=1) + slack
            square = length[who, None] ** 2
            most = (square + node.most**2 - np.maximum(nearest, 0) ** 2) / 2
            least = (square + node.least**2 - farthest**2) / 2
            most, least = most + MARGIN * (1 + abs(most)), least - MARGIN * (1 + abs(least))
            for j in np.argsort(-most.mean(axis=0)).tolist():
                # the window's annulus and what was found so far, against the bounds of the branch
                meets = (most[:, j, None] >= np.maximum(low[who], best[who, :, -1])) & (least[:, j, None] <= high[who])
                stay = who[meets.any(axis=1)]
                if len(stay):
                    visit(node.children[j], stay)

        visit(self.root, everyone[~big])
        return best, ids, compared


def _build(table: pa.Table) -> GnatBlock:
    table = table.combine_chunks()
    return GnatBlock(table.column("vec_id").to_numpy(), table.column("label").to_numpy(), matrix(table.column("vector").combine_chunks()))


def _batches(batch: pa.RecordBatch, size: int = 512) -> list[pa.RecordBatch]:
    return [batch.slice(i, size) for i in range(0, batch.num_rows, size)]


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    least_share: int = 30,
    most_share: int = 90,
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors(vec_id, label, vector)``.

    ``is_anchor`` is a condition over ``vec_id``; the shares of a positive's score that bound its negatives are in hundredths.
    """
    rows = stored(whole_vectors(vectors, scale, label="long").where("label is not null"), "gnat-rows")
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("q")).first()
    blocks = max(1, -(-sizes["n"] // block_rows))
    trees = block_index(rows, blocks, _build, "gnat-trees")
    anchors = rows.where(is_anchor)

    def nearest(tree: GnatBlock, asked: pa.RecordBatch, _: pa.RecordBatch | None) -> pa.RecordBatch:
        out: list[tuple[np.ndarray, ...]] = []
        for part in _batches(asked):
            who, label = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
            may = (label[:, None] == tree.labels[None, :]) & (who[:, None] != tree.ids[None, :])
            low = np.full((len(who), 1), LEAST + 1, dtype=np.int64)
            score, ids, _ = tree.search(matrix(part.column("vector")), may, low, np.full_like(low, np.iinfo(np.int64).max), positives)
            row, _, place = np.nonzero(score != LEAST)
            out.append((who[row], ids[row, 0, place], score[row, 0, place]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["anchor_id", "positive_id", "positive_score"])

    best = Best(("anchor_id",), "positive_score", "positive_id", positives)
    found = search_blocks(trees, blocks, anchors, "vec_id", sizes["q"], nearest, "anchor_id long, positive_id long, positive_score long", best, block_queries)
    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    own = stored(found.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= positives), "gnat-positives")
    # the window of an anchor's positives, at most ``positives`` of them
    asked = own.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("own"))
    asked = asked.select("anchor_id", "own.positive_id", "own.positive_score")
    windows = anchors.join(asked, anchors["vec_id"] == asked["anchor_id"]).select("vec_id", "label", "vector", "positive_id", "positive_score")

    def between(tree: GnatBlock, asked: pa.RecordBatch, _: pa.RecordBatch | None) -> pa.RecordBatch:
        out: list[tuple[np.ndarray, ...]] = []
        for part in _batches(asked):
            who, label = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
            names, given = part.column("positive_id").to_pylist(), part.column("positive_score").to_pylist()
            low = np.full((len(who), positives), 1, dtype=np.int64)
            high = np.zeros((len(who), positives), dtype=np.int64)  # no row is within 1..0
            for i, scores in enumerate(given):
                low[i, : len(scores)] = [-(-least_share * s // 100) for s in scores]
                high[i, : len(scores)] = [most_share * s // 100 for s in scores]
            may = label[:, None] != tree.labels[None, :]
            score, ids, _ = tree.search(matrix(part.column("vector")), may, low, high, negatives)
            row, window, place = np.nonzero(score != LEAST)
            pick_of = lambda values: np.array([values[i][w] for i, w in zip(row, window, strict=True)], dtype=np.int64)
            out.append((who[row], pick_of(names), pick_of(given), ids[row, window, place], score[row, window, place]))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
            ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
        )

    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    best = Best(("anchor_id", "positive_id"), "negative_score", "negative_id", negatives)
    mined = search_blocks(trees, blocks, windows, "vec_id", sizes["q"], between, schema, best, block_queries)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = mined.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle(label: str, anchor: str) -> str:
    """The counterpart over ``embeddings``, with the default parameters; ids are not repeated there."""
    return f"""
WITH v AS (SELECT vec_id, {label} AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, CAST(list_dot_product(a.v, x.v) AS BIGINT) AS score
      FROM v a JOIN v x ON a.vec_id <> x.vec_id WHERE {anchor.format('a.vec_id')}),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
      WHERE p.r <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
