"""The queries of this package: SQL counterparts, recall, exact round trips and held-out accuracy."""

import os
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points
from textloom.llm.common import table
from textloom.llm.queries import ORACLES, QUERIES
from textloom.llm.tokens import tokenizer_path


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


@pytest.fixture(scope="module")
def texts(duck):
    return duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def token_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in texts}


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_sql_counterpart(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(result.columns)
    order = [names.index(c) for c in result.columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in expected.fetchall()), key=repr)
    assert sorted((tuple(map(plain, r)) for r in result.collect()), key=repr) == want


def test_neighbours_recall(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").toPandas().sort_values("vec_id")
    x, ids = np.array(vectors["embedding"].tolist(), dtype=np.float64), vectors["vec_id"].to_numpy()
    asked = np.flatnonzero(ids % 20 == 0)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-score, axis=1, kind="stable")[:, :20]
    found = QUERIES["op1_cross_polytope"](spark, sf_dir).toPandas()
    got = found.groupby("query_id")["vec_id"].apply(set)
    recall = np.mean([len(got[ids[q]] & set(ids[b])) / 20 for q, b in zip(asked, best, strict=True)])
    assert recall >= 0.9
    assert (found["query_id"] != found["vec_id"]).all()
    place = {v: i for i, v in enumerate(ids)}
    for row in found.head(200).itertuples():
        assert row.score == pytest.approx(float(x[place[row.query_id]] @ x[place[row.vec_id]]), abs=1e-12)
    for _, own in found.groupby("query_id"):
        own = own.sort_values("rank")
        assert own["rank"].tolist() == list(range(1, len(own) + 1))
        assert own["score"].is_monotonic_decreasing


@pytest.mark.parametrize(("name", "label", "least"), [("op2_toxicity", "toxic", 0.75), ("op7_cotraining", "quality", 0.9)])
def test_held_out_accuracy(spark, sf_dir, name, label, least):
    sf_dir = os.path.join(os.path.dirname(sf_dir), "sf0.01")  # the smallest table holds too few labels to measure
    found = QUERIES[name](spark, sf_dir)
    assert found.count() == table(spark, sf_dir, "documents").count()
    judged = found.join(table(spark, sf_dir, "labels"), "doc_id").where("held_out").toPandas()
    good, bad = (judged[judged[label] == v]["score"].to_numpy() for v in (1, 0))
    auc = np.mean((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :]))
    assert auc >= least
    expected = [zlib.crc32(str(i).encode()) % 5 == 0 for i in (0, 1, 2, 3)]
    assert [r["held_out"] for r in found.where("doc_id < 4").orderBy("doc_id").collect()] == expected
    assert judged["score"].between(0, 1).all()


def test_near_copies_by_brute_force(spark, sf_dir, texts):
    sets, parent = {}, {}
    for i, t in texts:
        words = (t or "").encode().lower().split()
        sets[i] = set(zip(words, words[1:], words[2:], strict=False)) if len(words) >= 3 else ({tuple(words)} if words else set())
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for a in ids:
        for b in ids:
            if a < b and 10 * min(len(sets[a]), len(sets[b])) >= 9 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    found = QUERIES["op3_ngram_jaccard"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == {i: (len(sets[i]), root(i)) for i in sets}


def test_packing_round_trip(spark, sf_dir, token_ids):
    found = QUERIES["op5_best_fit_packing"](spark, sf_dir).toPandas()
    expected = {}
    for doc, ids in token_ids.items():
        ids = np.array([*ids, 0], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            expected[(doc, piece)] = (at, len(part), zlib.crc32(part.tobytes()))
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found.itertuples()}
    assert got == expected
    ordered = found.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"] == ordered["offset"]).all()
    assert ordered.groupby("sequence_id")["length"].sum().max() <= 2048
    assert found["sequence_id"].nunique() <= 1.01 * (found["length"].sum() / 2048) + 1


def test_arrow_files_round_trip(spark, sf_dir, token_ids):
    found = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op6_arrow_output"](spark, sf_dir).collect()}
    start, expected = 0, {}
    for doc in sorted(token_ids):
        ids = np.array([*token_ids[doc], 1], dtype="<u4")
        expected[doc] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert found == expected


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = table(spark, sf_dir, "documents")
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in table(spark, sf_dir, "labels").collect()}
    kept, columns = docs, docs.columns
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, kept, sf_dir)
        before = [r["doc_id"] for r in kept.select("doc_id").collect()]
        if name != "best-fit packing":
            assert made.columns == columns
            kept = spark.createDataFrame(made.collect(), made.schema)
        after = [r["doc_id"] for r in made.select("doc_id").distinct().collect()]
        assert set(after) <= set(before)
        sizes[name] = (len(set(before)), len(set(after)))
        gone = set(before) - set(after)
        if name == "toxicity":
            assert not [i for i in gone if labels.get(i, (1, 1))[1] == 0]
        if name == "quality classifier":
            assert sum(labels.get(i, (0, 0))[0] == 1 for i in gone) <= 0.02 * len(before)
    assert sizes["mixing to target weights"][0] == sizes["mixing to target weights"][1]
    assert sizes["best-fit packing"][0] == sizes["best-fit packing"][1]
    assert corpus_pipeline.ORACLE_SQL is None
