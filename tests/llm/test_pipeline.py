"""The pipeline against plain versions of its stages, on rows with every special case."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import DOCUMENTS, ODD_ROWS
from tests.llm.test_operators import brute_components, plain_best_fit
from textloom.llm import cotraining, toxicity
from textloom.llm.common import table
from textloom.llm.tokens import tokenizer_path
from textloom.session import scratch_path

EXTRA = ["score", "n", "fp", "group", "a", "b", "slot", "offset", "sequence_id", "key", "place_row", "label"]
INSULTS = "you stupid worthless idiot, you pathetic moron."


def given_rows():
    generator = random.Random(4)
    words = [f"w{generator.randrange(10**6)}" for _ in range(400)]
    out = list(ODD_ROWS)
    for i in range(20, 260):
        text = " ".join(generator.choices(words, k=generator.randint(5, 90))) + ".\nA last line."
        if i % 6 == 0:
            text = "### ||| " * generator.randint(5, 40)  # of low quality
        if i % 10 == 1:
            text += " " + INSULTS
        if i % 10 == 3 and len(out) > 30:
            text = out[-1][1] + " end"  # a near copy
        out.append((i, text, generator.choice(["en", "de", None]), generator.choice(["src1", "src2", "src3", None]), len(text)))
    return out


def written(spark, rows):
    path = scratch_path(spark, "pipeline-test")
    docs = spark.createDataFrame(rows, DOCUMENTS).selectExpr("*", *[f"'x' AS `{c}`" for c in EXTRA])
    docs.repartition(3, "doc_id").write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 0 if (r[1] or "").startswith("###") else 1, int(INSULTS in (r[1] or ""))) for r in rows if r[0] and r[0] >= 20]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def counted(df):
    return Counter(map(tuple, df.collect()))


def plain_quality(model, row):
    views = cotraining.content_view(row["text"] or ""), cotraining.metadata_view(row["text"] or "", row["lang"], row["source"])
    odds = [m.log_odds(x[None, :])[0] for m, x in zip((model.content, model.metadata), views, strict=True)]
    return 1 / (1 + np.exp(-np.mean(odds)))


def plain_one_of_each(rows):
    texts = sorted({(r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None}, key=lambda r: r[0])
    found = brute_components([t for _, t in texts], 5, 80)
    stays = {texts[i][0] for i, (_, first) in enumerate(found) if i == first}
    kept = {r["doc_id"]: r for r in rows if r["doc_id"] in stays}
    return Counter(map(tuple, kept.values())) + Counter(tuple(r) for r in rows if r["doc_id"] is None)


def test_stages_against_plain_versions(spark):
    from tokenizers import Tokenizer

    path = written(spark, given_rows())
    docs = table(spark, path, "documents")
    labels = table(spark, path, "labels")
    stages = dict(corpus_pipeline.STAGES)
    kept = {}
    for name, stage in list(stages.items())[:-1]:
        made = stage(spark, docs, path)
        assert made.columns == docs.columns
        kept[name] = (docs, made)
        docs = corpus_pipeline.stored(made, "pipeline-test-stage")

    before, made = kept["toxicity"]
    matcher = toxicity.Matcher(toxicity.learn(before, labels))
    assert counted(made) == Counter(tuple(r) for r in before.collect() if matcher.score(r["text"]) < 0.5)
    assert not [r for r in made.collect() if INSULTS in (r["text"] or "")]

    before, made = kept["quality classifier"]
    before = corpus_pipeline.stored(before, "pipeline-test-stage")
    model = cotraining.learn(before, labels)
    assert counted(made) == Counter(tuple(r) for r in before.collect() if plain_quality(model, r) >= 0.5)
    assert not [r for r in made.collect() if (r["text"] or "").startswith("###")]

    before, made = kept["n-gram Jaccard join"]
    assert counted(made) == plain_one_of_each(before.collect()) != counted(before)

    before, made = kept["mixing to target weights"]
    assert counted(made) == counted(before)

    tokenizer, pieces, lengths = Tokenizer.from_file(tokenizer_path()), Counter(), []
    for row in docs.collect():
        ids = np.array([*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for number, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            pieces[(row["doc_id"], number, at, len(part), zlib.crc32(part.tobytes()))] += 1
            lengths.append(len(part))
    result = corpus_pipeline.run(spark, path).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").toPandas()
    got = Counter((None if r.doc_id != r.doc_id else int(r.doc_id), *map(int, (r.piece, r.start, r.length, r.ids_crc32))) for r in result.itertuples())
    assert got == pieces
    assert result["sequence_id"].nunique() == len(plain_best_fit(lengths, 2048))
    ordered = result.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"] == ordered["offset"]).all()


@pytest.mark.parametrize("labelled", [False, True])
def test_empty_tables(spark, labelled):
    path = written(spark, given_rows()[:40])
    empty = scratch_path(spark, "pipeline-empty")
    table(spark, path, "documents").where(F.lit(False)).write.parquet(f"{empty}/documents.parquet")
    table(spark, path, "labels").where(F.lit(labelled)).write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []
