"""Ranked lexical search of all documents for every item, with trees of frequency-ordered term vectors.

Terms are maximal stretches of letters, digits and characters beyond ASCII, with A-Z lower-cased.  With N documents that have a
term, L their terms, n a document's terms, df the documents with a term and tf its count in one, a term weighs
``w = floor(1000 ln((2N + 2) / (2df + 1)))``, a document has ``m = 75 + 25 n N div L``, and its score for an item is the
sum of ``w * (10^9 tf div (1000 tf + 12 m))`` over the item's terms, repeats included.  All but w is whole-number work.

1. Items are dealt to groups of a bounded number of terms; one pass over all documents serves a group.
   It restricts every document to the group's terms and writes these vectors; N, L and df are counted from them.
2. Each task sorts the vectors of a block of documents by falling df and builds a tree of their shared prefixes, with
   equal stretches in one node and neighbouring small branches in one leaf.  A node holds the largest tf of every term
   below it, the smallest m and the smallest id.
3. An item goes down the tree depth first, best bound first: since a term's part grows with tf and falls with m, the
   node's maxima bound all scores below it.  A branch goes when its bound cannot enter the best ``k`` found
   so far (equal scores count by id); leaves are scored exactly.
4. Spark ranks the best of all tasks, per item and slice of documents first, then per item.

Terms are compared by two independent 64-bit hashes.

Defined cases: a null or termless text never scores but is a row like any other; an item without terms has no result; a null
``item_id`` takes no part; of repeated item ids the smallest text counts; repeated documents are documents of their own and
may both be returned; a null ``doc_id`` comes after all ids; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import blocks, pick, stored
from textloom.llm.words import BY_MARK, FOLD, U64, find_words, hash_words, text_bytes

BLOCK_DOCS = 8192
LEAF_DOCS = 24
GROUP_TERMS = 16_384
SLICES = 16
LAST = (1 << 63) - 1
VECTORS = "doc_id long, n long, terms array<int>, tf array<int>"


class TermTable:
    """The terms of a group of items: numbers by hash."""

    def __init__(self, first: np.ndarray, second: np.ndarray) -> None:
        order = np.argsort(first)
        self.first, self.second, self.number = first[order], second[order], order
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(first >> U64(48)).astype(np.int64)] = True

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the words are terms, their numbers)."""
        words = hash_words(data, starts, ends)
        near = np.flatnonzero(self.maybe[(words >> U64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.first, words[near]), len(self.first) - 1)
        hit = self.first[at] == words[near]
        near, at = near[hit], at[hit]
        same = hash_words(data, starts[near], ends[near], 1) == self.second[at]
        return near[same], self.number[at[same]]


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    data = FOLD[data]
    return data, *find_words(data, offsets, BY_MARK)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, first, second, n): the terms of each item as two hashes, with their number."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            data, starts, ends, bounds = _words(batch.column("text"))
            ids = pa.array(np.repeat(batch.column("item_id").to_numpy(), np.diff(bounds)))
            hashes = [pa.array(hash_words(data, starts, ends, lane).view(np.int64)) for lane in (0, 1)]
            yield pa.RecordBatch.from_arrays([ids, *hashes], ["item_id", "first", "second"])

    one = pick(items, item_id="long", text="string").where("item_id is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    words = one.mapInArrow(cut, "item_id long, first long, second long")
    return words.groupBy("item_id", "first", "second").agg(F.count("*").alias("n"))


def term_vectors(docs: DataFrame, terms: TermTable) -> DataFrame:
    """Every document restricted to ``terms``, see ``VECTORS``; ``n`` counts all its terms."""
    shipped = docs.sparkSession.sparkContext.broadcast(terms)  # GROUP_TERMS entries, or those of one item

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped.value
        size = len(table.number)
        for batch in blocks(batches, "text"):
            data, starts, ends, bounds = _words(batch.column("text"))
            which, number = table.find(data, starts, ends)
            text = np.searchsorted(bounds, which, side="right") - 1
            found, tf = np.unique(text * size + number, return_counts=True)
            cuts = pa.array(np.searchsorted(found, np.arange(batch.num_rows + 1) * size).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (found % size, tf)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(bounds)), *lists], ["doc_id", "n", "terms", "tf"])

    return pick(docs, doc_id="long", text="string").mapInArrow(restrict, VECTORS)


class FPTree:
    """The prefix tree of a block of documents; terms are numbered by falling document frequency."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, cuts: np.ndarray, terms: np.ndarray, tf: np.ndarray, size: int, leaf: int = LEAF_DOCS) -> None:
        path = terms.astype(">u4").tobytes()
        paths = [path[4 * a : 4 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        order = np.array(sorted(range(len(ids)), key=paths.__getitem__), dtype=np.int64)
        self.paths, self.leaf = [paths[i] for i in order.tolist()], leaf
        self.ids, self.m = ids[order], m[order]
        length = np.diff(cuts)[order]
        self.cuts = np.concatenate([[0], np.cumsum(length)])
        take = np.repeat(cuts[order], length) + np.arange(len(terms)) - np.repeat(self.cuts[:-1], length)
        self.terms, self.tf = terms[take], tf[take].astype(np.int64)
        self.children: list[list[int]] = []
        self.rows: list[tuple[int, int]] = []
        self._grow(0, len(ids))
        # maxima: of the leaves from their documents, of the rest from their children
        self.top = np.zeros((len(self.rows), size), dtype=np.int32)
        self.least_m = np.zeros(len(self.rows), dtype=np.int64)
        self.least_id = np.zeros(len(self.rows), dtype=np.int64)
        for node in range(len(self.rows) - 1, -1, -1):  # children have larger numbers
            low, high = self.rows[node]
            self.least_m[node], self.least_id[node] = self.m[low:high].min(), self.ids[low:high].min()
            if self.children[node]:
                self.top[node] = self.top[self.children[node]].max(axis=0)
            else:
                a, b = self.cuts[low], self.cuts[high]
                np.maximum.at(self.top[node], self.terms[a:b], self.tf[a:b].astype(np.int32))

    def _node(self, low: int, high: int) -> int:
        self.rows.append((low, high))
        self.children.append([])
        return len(self.rows) - 1

    def _grow(self, low: int, high: int) -> None:
        todo = [self._node(low, high)]
        while todo:
            node = todo.pop()
            low, high = self.rows[node]
            if high - low <= self.leaf:
                continue
            # sorted paths: what the first and the last share, all share
            first, last = self.paths[low], self.paths[high - 1]
            depth = next((i for i in range(0, min(len(first), len(last)), 4) if first[i : i + 4] != last[i : i + 4]), min(len(first), len(last)))
            steps = [p[depth : depth + 4] for p in self.paths[low:high]]
            cuts = [low, *(low + i for i in range(1, high - low) if steps[i] != steps[i - 1]), high]
            if len(cuts) == 2:  # equal paths
                cuts = [*range(low, high, self.leaf), high]
            at = low
            for this, then in zip(cuts[1:], [*cuts[2:], None], strict=True):
                # neighbours go on in one branch while they are few
                if then is None or then - at > self.leaf:
                    child = self._node(at, this)
                    self.children[node].append(child)
                    todo.append(child)
                    at = this

    def search(self, terms: np.ndarray, weight: np.ndarray, best: Best) -> int:
        """Improves ``best`` by the documents of the tree; returns how many it scored."""
        tf = self.top[:, terms].astype(np.int64)
        bound = (weight * (1_000_000_000 * tf // (1000 * tf + 12 * self.least_m[:, None]))).sum(axis=1)
        value = np.zeros(self.top.shape[1], dtype=np.int64)
        value[terms] = weight
        bounds, least = bound.tolist(), self.least_id.tolist()
        todo, scored = [0], 0
        while todo:
            node = todo.pop()
            if not best.may_enter(bounds[node], least[node]):
                continue
            if self.children[node]:
                todo += sorted(self.children[node], key=bounds.__getitem__)
                continue
            low, high = self.rows[node]
            a, b = self.cuts[low], self.cuts[high]
            w = value[self.terms[a:b]]
            use = np.flatnonzero(w)
            row = np.searchsorted(self.cuts[low : high + 1], use + a, side="right") - 1
            tf = self.tf[a:b][use]
            score = np.zeros(high - low, dtype=np.int64)
            np.add.at(score, row, w[use] * (1_000_000_000 * tf // (1000 * tf + 12 * self.m[low:high][row])))
            best.add(score, self.ids[low:high])
            scored += high - low
        return scored


class Best:
    """The best ``k`` scores above 0 so far, equal ones by id."""

    def __init__(self, k: int) -> None:
        self.k, self.found = k, []

    def may_enter(self, score: int, doc: int) -> bool:
        return score > 0 and (len(self.found) < self.k or (-score, doc) < self.found[-1])

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        edge = -self.found[-1][0] if len(self.found) == self.k else 1
        near = np.flatnonzero(scores >= edge)
        if len(near):
            self.found = sorted([*self.found, *zip((-scores[near]).tolist(), ids[near].tolist(), strict=True)])[: self.k]


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def best_documents(vectors: DataFrame, asked: list[tuple[int, np.ndarray, np.ndarray]], rank: np.ndarray, n: int, total: int, k: int, block_docs: int) -> DataFrame:
    """(item_id, doc_id, score): for each item the best ``k`` of each task."""
    shipped = vectors.sparkSession.sparkContext.broadcast((asked, rank))  # the terms of one group of items

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, place = shipped.value
        best = [Best(k) for _ in items]
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def flush() -> None:
            ids, m, lengths, terms, tf = (np.concatenate(x) for x in zip(*held, strict=True))
            tree = FPTree(ids, m, np.concatenate([[0], np.cumsum(lengths)]), terms, tf, len(place))
            for (_, numbers, weight), found in zip(items, best, strict=True):
                tree.search(numbers, weight, found)

        for batch in batches:
            for start in range(0, batch.num_rows, block_docs):
                part = batch.slice(start, block_docs)
                ids = part.column("doc_id").fill_null(LAST).to_numpy()
                size = part.column("n").to_numpy()
                if int(size.max(initial=0)) * n * 25 < LAST:
                    m = 75 + 25 * size * n // max(1, total)
                else:
                    m = np.array([75 + 25 * int(x) * n // total for x in size], dtype=np.int64)
                terms, cuts = _lists(part.column("terms"))
                tf, _ = _lists(part.column("tf"))
                doc = np.repeat(np.arange(part.num_rows), np.diff(cuts))
                order = np.lexsort((place[terms], doc))
                held.append((ids, m, np.diff(cuts), place[terms][order], tf[order]))
                count += part.num_rows
                if count >= block_docs:
                    flush()
                    held, count = [], 0
        if count:
            flush()
        rows = [(item, None if doc == LAST else doc, -score) for (item, _, _), b in zip(items, best, strict=True) for score, doc in b.found]
        for start in range(0, len(rows), 10_000):
            columns = list(zip(*rows[start : start + 10_000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    return vectors.where(F.size("terms") > 0).mapInArrow(search, "item_id long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, block_docs: int = BLOCK_DOCS, group_terms: int = GROUP_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's best ``k`` documents of ``docs`` with a score above 0."""
    asked = stored(item_terms(items), "item-terms")
    count = asked.count()
    groups = max(1, -(-count // group_terms))
    found = None
    for group in range(groups):  # one pass over the documents for every bounded group of terms
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == group).toPandas()
        if not len(mine):
            continue
        first, second = (mine[c].to_numpy(dtype=np.int64).view(U64) for c in ("first", "second"))
        pairs, number = np.unique(np.stack([first, second], axis=1), axis=0, return_inverse=True)
        vectors = stored(term_vectors(docs, TermTable(pairs[:, 0].copy(), pairs[:, 1].copy())), "term-vectors")
        sums = vectors.where("n > 0").agg(F.count("*").alias("n"), F.sum("n").alias("total")).first()
        counted = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).toPandas()
        df = np.zeros(len(pairs), dtype=np.int64)
        df[counted["term"].to_numpy(dtype=np.int64)] = counted["n"].to_numpy(dtype=np.int64)
        rank = np.empty(len(pairs), dtype=np.int64)
        rank[np.argsort(-df, kind="stable")] = np.arange(len(pairs))
        weight = np.floor(1000 * np.log((2 * sums["n"] + 2) / (2 * df + 1))).astype(np.int64)
        mine["term"] = number.ravel()
        group_items = [
            (int(item), rank[own["term"].to_numpy()], own["n"].to_numpy(dtype=np.int64) * weight[own["term"].to_numpy()])
            for item, own in mine.groupby("item_id")
        ]
        part = best_documents(vectors, group_items, rank, sums["n"], sums["total"] or 0, k, block_docs)
        found = part if found is None else found.union(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    slices = F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))
    first = F.row_number().over(Window.partitionBy("item_id", "slice").orderBy(*order))
    few = found.withColumn("slice", slices).withColumn("place", first).where(F.col("place") <= k)
    last = F.row_number().over(Window.partitionBy("item_id").orderBy(*order)).cast("int")
    return few.withColumn("rank", last).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


_TERMS = """list_transform(regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'),
  lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"""
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS t FROM documents),
g AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(t)) AS BIGINT) AS total FROM d WHERE len(t) > 0),
e AS (SELECT k, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT k, unnest(t) AS term FROM d) GROUP BY k, term),
i AS (SELECT item_id, term, CAST(count(*) AS BIGINT) AS c FROM (SELECT item_id, unnest({_TERMS}) AS term FROM
        (SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id)) GROUP BY item_id, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * g.n + 2 AS DOUBLE) / CAST(2 * x.df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM e GROUP BY term) x, g),
m AS (SELECT k, doc_id, 75 + ((25 * CAST(len(t) AS BIGINT) * g.n) // g.total) AS m FROM d, g WHERE len(t) > 0),
s AS (SELECT i.item_id, m.doc_id, CAST(sum(i.c * w.w * ((1000000000 * e.tf) // (1000 * e.tf + 12 * m.m))) AS BIGINT) AS score
      FROM i JOIN e USING (term) JOIN w USING (term) JOIN m USING (k) GROUP BY i.item_id, m.doc_id, k),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""
