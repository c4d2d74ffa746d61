"""Hard negatives by GNAT trees and ranked search by prefix trees, against plain loops."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LONG, no_documents, odd_documents
from textloom.llm import fp_tree, gnat
from textloom.llm.vector_blocks import LEAST, MOST, products, whole_vectors

VECTORS = "vec_id long, label int, vector array<double>"


# ------------------------------------------------------------ hard negatives
def plain_negatives(rows, anchor, positives=5, negatives=10, low=30, high=90, scale=256):
    held = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x * scale) for x in v):
            continue
        whole = ([math.floor(x * scale) for x in v], label)
        held[i] = min(held.get(i, whole), whole)
    out = []
    for a, (va, la) in held.items():
        if a % anchor:
            continue
        score = {i: min(max(sum(x * y for x, y in zip(va, v, strict=False)), LEAST), MOST) for i, (v, _) in held.items() if i != a}
        best = sorted((-s, i) for i, s in score.items() if held[i][1] == la)[:positives]
        for s, p in best:
            fits = sorted((-t, i) for i, t in score.items() if held[i][1] != la and low * -s <= 100 * t <= high * -s)
            out += [(a, p, r, i, -s, -t) for r, (t, i) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def clusters(n, dim, seed, spread=0.1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1)[:, None], rng.integers(0, 4, n)


@pytest.mark.parametrize(("dim", "block_rows"), [(4, 4096), (16, 150), (2, 300)])
def test_negatives_by_plain_loops(spark, dim, block_rows):
    x, label = clusters(600, dim, dim)
    x[50:120] = x[7]  # ties
    rows = [(i, int(la), v.tolist()) for i, (v, la) in enumerate(zip(x, label, strict=True))]
    found = gnat.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, block_rows=block_rows, block_queries=10)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, 20)


def test_branches_are_eliminated():
    x, label = clusters(4000, 8, 1, 0.05)
    x = np.floor(256 * x)
    tree = gnat.GnatBlock(np.arange(4000), label, x)
    assert tree.root.children and all(c.children for c in tree.root.children if len(c.rows) > 64)
    may = np.ones((40, 4000), dtype=bool)
    scores = np.sort(products(x[:40], x), axis=1)
    low, high = scores[:, [2000]], scores[:, [2100]]
    best, _, compared = tree.search(x[:40], may, low, high, 10)
    assert compared < 0.5 * may.size
    for i in range(40):
        fits = [s for s in scores[i][::-1] if low[i, 0] <= s <= high[i, 0]][:10]
        assert best[i, 0].tolist() == fits


def test_negatives_special_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(100 * i, i % 2, [1.0, i / 10]) for i in range(5)] + [(i, i % 3, [i / 50, 1.0 - i / 70]) for i in range(1, 60)]
    rows += [(300, 1, [0.1, 0.2]), (61, None, [1.0, 1.0]), (62, 1, None), (None, 1, [1.0, 1.0]), (63, 1, [nan, 1.0]), (64, 1, [None, 1.0])]
    rows += [(65, 1, [inf, 1.0]), (66, 0, [70000.0, 3.0]), (67, 1, [-1e9, 2.0]), (68, 0, [1e307, 1.0]), (69, 0, []), (70, 1, [0.5]), (71, 0, [0.0, 0.0])]
    rows += [(500, 0, [-2e5, 0.25]), (600, 3, [1.0, 1.0]), (700, 1, [1e15, 1e15]), (72, 0, [1e15, 1.0]), (73, 1, [1e15, 2.0])]
    given = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS Label", "'x' AS block", "'x' AS part", "'x' AS kind", "'x' AS `index`")
    found = gnat.hard_negatives(given, F.col("vec_id") % 100 == 0, block_rows=20)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, 100)
    assert gnat.hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 100 == 0).collect() == []


def test_products_are_exact():
    rng = np.random.default_rng(5)
    a = np.floor(rng.normal(size=(20, 1024)) * 70_000 * 64)
    a[3] *= 1e6
    b = np.concatenate([a[:7], np.floor(rng.normal(size=(5, 1024)))])
    got = products(a, b)
    for i in range(len(a)):
        for j in range(len(b)):
            exact = sum(int(x) * int(y) for x, y in zip(a[i], b[j], strict=True))
            assert got[i, j] == min(max(exact, LEAST), MOST)


def test_whole_vectors_keep_every_finite_row(spark):
    rows = [(1, [70_000.0, -0.3]), (2, [1e300, 0.0]), (3, [1e308, 1.0]), (4, [float("nan")]), (1, [1.0, 1.0])]
    got = {r["vec_id"]: r["vector"] for r in whole_vectors(spark.createDataFrame(rows, "vec_id long, vector array<double>"), 64).collect()}
    assert got == {1: [64.0, 64.0], 2: [64e300, 0.0]}


# ------------------------------------------------------------ ranked search
def terms_of(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in found]


def plain_ranks(docs, items, k=20):
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, total = len(bags), sum(x for _, _, x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    held = {}
    for item, text in items:
        if item is not None and text is not None:
            held[item] = min(held.get(item, text), text)
    for item, text in held.items():
        scored = []
        for doc, bag, length in bags:
            m = 75 + 25 * length * n // total
            score = 0
            for t in terms_of(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def ranks(found):
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize(("block_docs", "group_terms", "letters"), [(8192, 16_384, 30), (60, 40, 200), (25, 16_384, 4)])
def test_ranks_by_plain_loops(spark, block_docs, group_terms, letters):
    random.seed(letters)
    words = [f"W{i}" for i in range(letters)]
    odds = [1 / (1 + i) for i in range(letters)]
    docs = [(i, " ".join(random.choices(words, odds, k=random.randint(0, 40)))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(90)] + [(2000, docs[5][1])] * 3  # ties and repeated rows
    items = [(i, ", ".join(random.choices([*words, "none"], k=random.randint(0, 12)))) for i in range(25)]
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    assert ranks(fp_tree.rank_documents(*frames, block_docs=block_docs, group_terms=group_terms)) == plain_ranks(docs, items)


def test_tree_shares_paths_and_prunes():
    rng = np.random.default_rng(8)
    size, n = 300, 3000
    rows = [np.unique(np.concatenate([np.arange(rng.integers(1, 4)), np.minimum(rng.zipf(1.3, 6) + 3, size - 1)])) for _ in range(n)]
    cuts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    terms = np.concatenate(rows)
    tree = fp_tree.FPTree(np.arange(n), np.full(n, 100), cuts, terms, rng.integers(1, 9, len(terms)), size)
    leaves = [r for r, c in zip(tree.rows, tree.children, strict=True) if not c]
    assert sorted(i for a, b in leaves for i in range(a, b)) == list(range(n))
    for node, children in enumerate(tree.children):
        assert not children or [tree.rows[c] for c in children][0][0] == tree.rows[node][0]
        low, high = tree.rows[node]
        top = np.zeros(size, dtype=np.int64)
        np.maximum.at(top, tree.terms[tree.cuts[low] : tree.cuts[high]], tree.tf[tree.cuts[low] : tree.cuts[high]])
        assert (tree.top[node] == top).all()
    best = fp_tree.Best(5)
    assert tree.search(np.array([1, 60]), np.array([50, 4000]), best) < 0.5 * n
    assert len(best.found) == 5


def test_ranks_special_cases(spark):
    docs = odd_documents(spark)
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(1, "ONE two, two! été 你好"), (2, None), (3, ""), (3, "moron"), (None, "one"), (4, LONG[:5000]), (5, "\U0001f600 zzz"), (6, "six six")]
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS Text", "'x' AS n", "'x' AS first")
    assert ranks(fp_tree.rank_documents(docs, asked)) == plain_ranks(given, items)
    assert fp_tree.rank_documents(no_documents(spark), asked).collect() == []
    assert fp_tree.rank_documents(docs, asked.limit(0)).collect() == []
