"""Long repeats by recompression, against plain loops."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import LONG, no_documents, odd_documents
from textloom.llm import recompression
from textloom.llm.words import BY_MARK, BY_SPACE, find_words, hash_words, joined, text_bytes

SPLIT = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_removal(rows, window):
    late = 1 << 63
    words = [SPLIT.findall((t or "").encode()) for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words, strict=True):
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, 2 * late), late if i is None else i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < (late if i is None else i):
                gone[p : p + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=repr)


def test_words_of_columns():
    random.seed(4)
    texts = ["".join(random.choice("ab Aé\n\t.1") for _ in range(random.randint(0, 30))) for _ in range(400)]
    texts += [None, "", "  ", "x" * 5000 + " y", "你好 ok", "a" * 8, "a" * 16, "a" * 17]
    random.shuffle(texts)
    data, offsets = text_bytes(pa.array(texts).slice(3))
    for inner, pattern in ((BY_SPACE, SPLIT), (BY_MARK, re.compile(rb"[0-9A-Za-z\x80-\xff]+"))):
        starts, ends, bounds = find_words(data, offsets, inner)
        names = {}
        one, two = (hash_words(data, starts, ends, lane).tolist() for lane in (0, 1))
        for i, text in enumerate(texts[3:]):
            found = [data[starts[k] : ends[k]].tobytes() for k in range(bounds[i], bounds[i + 1])]
            assert found == pattern.findall((text or "").encode())
            for k, word in zip(range(bounds[i], bounds[i + 1]), found, strict=True):
                assert names.setdefault(word, (one[k], two[k])) == (one[k], two[k])
        assert len({a for a, _ in names.values()}) == len({b for _, b in names.values()}) == len(names)
    starts, ends, bounds = find_words(data, offsets, BY_SPACE)
    out, at = joined(data, offsets, starts, ends, bounds)
    assert [out[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)] == [b" ".join(SPLIT.findall((t or "").encode())) for t in texts[3:]]


def test_equal_stretches_have_equal_interior_symbols():
    random.seed(9)
    window = 50
    for letters in (["a", "b"], list("abcdefgh"), [f"w{i}" for i in range(500)]):
        stretch = random.choices(letters, k=window)
        texts = []
        for _ in range(30):
            texts.append(" ".join([*random.choices(letters, k=random.randint(0, 60)), *stretch, *random.choices(letters, k=random.randint(0, 60))]))
        parsed = recompression.Parsed(pa.array(texts))
        name, text, low, high = parsed.anchors(window, 1)
        seen = None
        for i in range(len(texts)):
            words = texts[i].split()
            at = next(p for p in range(len(words)) if words[p : p + window] == stretch) + parsed.bounds[i]
            inside = (text == i) & (low >= at) & (high <= at + window)
            symbols = list(zip(name[inside].tolist(), (low[inside] - at).tolist(), (high[inside] - at).tolist(), strict=True))
            assert seen is None or symbols == seen
            seen = symbols
        assert len(letters) == 2 or seen


@pytest.mark.parametrize("seed", range(5))
def test_against_plain_loops(spark, seed):
    random.seed(seed)
    window = [6, 8, 20, 50, 12][seed]
    letters = [["a"], ["a", "b"], ["a", "b", "c"], [f"w{i}" for i in range(50)], ["x", "y"]][seed]
    pool = [" ".join(random.choices(letters, k=random.randint(1, 3 * window))) for _ in range(8)]
    pool += ["a b " * 100, "a " * 200, "a b c " * 60]  # runs of words and of longer periods
    rows = []
    for i in range(60):
        parts = [random.choice([random.choice(pool), " ".join(random.choices([*letters, "q", "r"], k=random.randint(0, 2 * window)))]) for _ in range(random.randint(0, 5))]
        rows.append((random.choice([i, i, i, None, i // 2]), random.choice([" ".join(parts), " \t\n".join(parts), None]) if i % 9 == 0 else " ".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = recompression.remove_repeats(docs, window=window, one_in=1 + seed % 3, bucket_words=300)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_removal(rows, window)


def test_large_groups_of_copies(spark):
    random.seed(2)
    shared = " ".join(f"s{random.randrange(10_000)}" for _ in range(80))
    rows = [(i, shared) for i in range(1500)] + [(2000 + i, f"head{i} {shared} tail{i}") for i in range(600)]
    found = {r["doc_id"]: tuple(r)[1:3] for r in recompression.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_text=False).collect()}
    assert found == {0: (80, 0)} | {i: (80, 80) for i in range(1, 1500)} | {2000 + i: (82, 80) for i in range(600)}


def test_special_cases(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for window in (3, 50):
        found = recompression.remove_repeats(docs, window=window)
        assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
        assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_removal(rows, window)
    assert recompression.remove_repeats(no_documents(spark)).collect() == []
    # one text of ten million characters, and one that repeats a part of it
    words = np.random.default_rng(3).integers(0, 200_000, 1_500_000).astype(str).tolist()
    long = [(1, " ".join(words[700_000:700_060])), (2, " ".join(words)), (3, LONG + " " + " ".join(words[-49:])), (4, " ".join(words[-50:]))]
    found = {r["doc_id"]: r["n_removed"] for r in recompression.remove_repeats(spark.createDataFrame(long, "doc_id long, text string"), with_text=False).collect()}
    assert found == {1: 0, 2: 60, 3: 0, 4: 50}
