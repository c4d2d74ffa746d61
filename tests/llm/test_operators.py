"""Special cases and inner workings of the operators of this package, against plain versions."""

import itertools
import math
import pickle
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LONG, no_documents, odd_documents, rows
from textloom.llm import (
    arrow_output,
    components,
    cotraining,
    cross_polytope,
    gnat,
    impact_index,
    mixing_pfair,
    ngram_jaccard,
    packing,
    reply_trees,
    toxicity,
    url_templates,
    vector_blocks,
)
from textloom.llm.common import stored, with_place
from textloom.llm.tokens import WordEncoder, tokenizer_path
from textloom.session import scratch_path


# ------------------------------------------------------------------ tokens
def test_words_encode_like_whole_texts():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    random.seed(3)
    letters = "aAbé.,!'s \u0301<|endoftext|>ßΣσ  İ1２»…#\n\t-\0"
    texts = ["".join(random.choice(letters) for _ in range(50)) for _ in range(800)]
    texts += [None, "", "<|endoftext|>", "<|ENDOFTEXT|> a", LONG, "x" * 16 + " " + "x" * 17 + " a\0 a", "it's. don't!"]
    for sizes in ((1 << 12, 100_000), (32, 2_000)):
        encoder = WordEncoder(tokenizer_path(), *sizes)
        for start in range(0, len(texts), 60):
            part = texts[start : start + 60]
            got = [ids.tolist() for ids in encoder.encode(part)]
            assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in part]


def test_case_is_folded_in_plain_words_only():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    # only the lower-case letter has a composed form, and the tokenizer composes before it folds
    marked = ["H\u0331", "T\u0308", "W\u030a", "Y\u030a", "J\u030c"]
    texts = [*marked, *map(str.lower, marked), "Ba" + marked[0] + "T and THE Word " + marked[4] + "OB " + marked[4].lower() + "ob", "The WORD", LONG]
    assert any(plain.encode(m).ids != plain.encode(m.lower()).ids for m in marked)
    got = [ids.tolist() for ids in WordEncoder(tokenizer_path(), 1 << 12, 100_000).encode(texts)]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


# ----------------------------------------------------------------- packing
def plain_best_fit(lengths, size):
    """Rooms left after best-fit decreasing, piece by piece."""
    room: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(size - n)
    return sorted(room)


def test_best_fit_takes_the_tightest_bin():
    random.seed(5)
    for size, many in ((1, 300), (7, 300), (64, 300), (64, 2000), (2048, 300), (2048, 1500)):
        lengths = [random.choice([random.randint(1, size), random.randint(1, max(1, size // 5)), size // 2 + 1]) for _ in range(many)]
        counts = {n: lengths.count(n) for n in set(lengths)}
        used, given = {}, {n: [] for n in counts}
        for length, first, pieces, sequence, per, offset in packing.best_fit_decreasing(counts, size).tolist():
            given[length] += range(first, first + pieces)
            for i in range(pieces):
                used.setdefault(sequence + i // per, []).append((offset + i % per * length, length))
        assert all(sorted(g) == list(range(counts[n])) for n, g in given.items())
        rooms = []
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            rooms.append(size - at)
        assert sorted(rooms) == plain_best_fit(lengths, size)
        assert sorted(used) == list(range(len(used)))


def test_packing_is_one_for_all(spark):
    # pieces that only fit together across any division of the table; more than 100 000 of them
    half = 52_000
    rows = spark.range(2 * half).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") < half, 1100).otherwise(900).cast("long").alias("length")
    )
    packed = packing.pack(stored(rows.repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id"), "halves"))
    sums = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high"))
    assert [tuple(r) for r in sums.groupBy("n", "low", "high").count().collect()] == [(2000, 0, 1100, half)]
    assert sums.agg(F.max("sequence_id")).first()[0] == half - 1


def test_packing_special_cases(spark):
    packed = packing.pack_documents(odd_documents(spark), size=64, run_rows=3).toPandas()
    assert len(packed[packed["doc_id"] == 2]) == 2
    assert packed[packed["doc_id"] == 3][["start", "length"]].values.tolist() == [[0, 1]]
    assert packed["doc_id"].isna().sum() == 1
    for _, own in packed.sort_values("offset").groupby("sequence_id"):
        assert (own["length"].cumsum() - own["length"] == own["offset"]).all()
        assert own["length"].sum() <= 64
    assert packing.pack_documents(no_documents(spark)).collect() == []


def test_packing_follows_the_mix(spark):
    random.seed(8)
    sources = ["a"] * 300 + ["b"] * 300
    random.shuffle(sources)
    given = [(i, " ".join(["the"] * random.choice([3, 9, 20, 50, 150])), s) for i, s in enumerate(sources)]
    docs = spark.createDataFrame(given, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 3), ("b", 1)], "source string, weight int")
    mixed = mixing_pfair.mixed(docs, weights, block_rows=5)
    # from the stored files and straight from the plan
    for table in (stored(mixed, "mixed"), mixed):
        order = [r["doc_id"] for r in mixed.collect()]
        packed = packing.pack_documents(table, size=64, run_rows=20).toPandas().sort_values(["sequence_id", "offset"])
        assert len(packed) == sum(-(-(len(t.split()) + 1) // 64) for _, t, _ in given)
        assert packed.groupby("sequence_id")["length"].sum().max() <= 64
        # three parts of "a" to one of "b" until "a" runs out
        is_a = np.array([sources[i] == "a" for i in packed["doc_id"]])
        tokens = packed["length"].to_numpy()
        at = tokens.cumsum() / tokens.sum()
        for low, high in ((0, 0.3), (0.3, 0.6)):
            part = (at > low) & (at <= high)
            assert 0.65 <= tokens[part & is_a].sum() / tokens[part].sum() <= 0.85
        assert not is_a[at > 0.85].any()
        # pieces of any place may share a sequence, but most stay near their own
        place = {doc: i for i, doc in enumerate(order)}
        drift = [abs(place[doc] - i * len(order) / len(packed)) for i, doc in enumerate(packed["doc_id"])]
        assert np.mean(drift) < 40


def test_order_of_stored_files(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.col("id").cast("int") % 300).alias("text"))
    sizes = [3, 400, 5, 300, 292]  # the scan takes large files first
    path, at = scratch_path(spark, "order"), 0
    for number, n in enumerate(sizes):
        part = df.where(F.col("doc_id").between(at, at + n - 1)).coalesce(1).sortWithinPartitions("doc_id")
        part.write.parquet(f"{path}/{number}")
        at += n
    read = spark.read.option("recursiveFileLookup", "true").parquet(path)
    for table in (read, read.where("doc_id % 3 = 0"), df, read.orderBy(F.desc("doc_id"))):
        rows_ = with_place(table).orderBy("place_file", "place_row").collect()
        ids = [r["doc_id"] for r in rows_]
        assert ids == [r["doc_id"] for r in table.orderBy("doc_id").collect()][:: -1 if ids[0] > ids[-1] else 1]
    assert ids[0] == 999


# ------------------------------------------------------------ Arrow output
def test_arrow_files_special_cases(spark, tmp_path):
    shards = arrow_output.write_shards(odd_documents(spark), length=32, shard_chars=100_000, folder=f"file://{tmp_path}/out")
    found = arrow_output.read_documents(shards, with_ids=True).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [None, 1, 2, 2, 3, 4, 5, 6, 7, 8]
    assert [r["start"] for r in found] == list(itertools.accumulate([0, *[r["n_tokens"] for r in found[:-1]]]))
    assert all(r["ids"][-1] == 1 and len(r["ids"]) == r["n_tokens"] for r in found)
    assert [r["ids"] for r in found if r["doc_id"] in (3, 4)] == [[1], [1]]
    assert arrow_output.read_documents(arrow_output.write_shards(no_documents(spark))).collect() == []


def test_sequences_are_views_of_the_file(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "f g")], "doc_id long, text string")
    shards = arrow_output.write_shards(docs, length=4, folder=f"file://{tmp_path}/out")
    reader = arrow_output.open_shard(shards.index.first()["file"])
    before = pa.total_allocated_bytes()
    ids, mask = arrow_output.sequence(reader, 2)
    assert len(ids) == 4 and mask.tolist() == [True, False, False, False]
    assert not ids.flags.owndata
    assert pa.total_allocated_bytes() - before < 4096


# ---------------------------------------------------------- n-gram Jaccard
def brute_components(texts, words, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(range(len(texts)), 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
                low = min(label[a], label[b])
                label[a] = label[b] = low
                changed = True
    return [(len(s), c) for s, c in zip(sets, label, strict=True)]


@pytest.mark.parametrize(("words", "percent", "block"), [(3, 90, 5), (5, 80, 1024)])
def test_jaccard_against_all_pairs(spark, words, percent, block):
    random.seed(words)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for base in range(8):  # groups of near copies, chains, and a passage that all share
        origin = [f"b{base}w{random.randint(0, 400)}" for _ in range(random.randint(3, 160))]
        for _ in range(random.randint(1, 14)):
            copy = list(origin)
            for _ in range(random.randint(0, 5)):
                copy[random.randrange(len(copy))] = f"x{random.randint(0, 10**6)}"
            texts.append(" ".join(copy + passage * (base % 2)))
    texts += ["", None, "a", "A", "a b", "a b c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = ngram_jaccard.jaccard_components(docs, words, percent, block)
    assert [(r["n_shingles"], r["component_id"]) for r in found.orderBy("doc_id").collect()] == brute_components(texts, words, percent)


def test_jaccard_special_cases(spark):
    found = rows(ngram_jaccard.jaccard_components(odd_documents(spark)))
    by_id = {r[0]: r[1:] for r in found}
    assert len(found) == 10
    assert by_id[1] == by_id[2] == (4, 1)
    assert by_id[None] == (4, None)
    assert by_id[3] == (0, 3) and by_id[4] == (0, 4)
    kept = ngram_jaccard.keep_one_each(odd_documents(spark))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "4", "5", "6", "7", "8", "None"]
    assert ngram_jaccard.jaccard_components(no_documents(spark)).collect() == []
    several = [(1, "a b c d"), (1, "e f g h"), (2, "a b c d"), (3, "e f g h"), (4, "z")]
    found = ngram_jaccard.jaccard_components(spark.createDataFrame(several, "doc_id long, text string"))
    assert {(r["doc_id"], r["component_id"]) for r in found.collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_components(spark):
    random.seed(1)
    edges = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, None)]
    label = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for _ in range(len(label)):
        for a, b in edges:
            if b is not None and a != b:
                label[a] = label[b] = min(label[a], label[b])
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == label


# ------------------------------------------------------------------ mixing
def test_pfair_deviation_stays_below_one_block(spark):
    weights = {"=a": 7, "=b": 3, "=c": 1, "=d": 5}
    schedule = mixing_pfair.period_schedule(spark.createDataFrame(list(weights.items()), "name string, weight int"))
    order = [r["name"] for r in schedule.orderBy("slot").collect()]
    assert len(order) == 16
    got = dict.fromkeys(weights, 0)
    for slot, name in enumerate(order, 1):
        got[name] += 1
        assert all(abs(got[n] - slot * w / 16) < 1 for n, w in weights.items())


def plain_pfair(weights):
    """Earliest deadline first over the released blocks, slot by slot."""
    period, got, picks = sum(weights.values()), dict.fromkeys(weights, 0), []
    for slot in range(period):
        released = [n for n, w in weights.items() if got[n] * period // w <= slot]
        best = min(released, key=lambda n: (-(-(got[n] + 1) * period // weights[n]), -weights[n], n))
        got[best] += 1
        picks.append(best)
    return picks


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 3, "b": 2, "c": 2}, {"a": 97, "b": 31, "c": 1, "d": 31}, {"x": 7, "y": 7}, {"x": 1, "y": 99}])
@pytest.mark.parametrize("times", [1, 6, 1_000_003])
def test_pfair_schedule_against_plain_steps(spark, weights, times):
    """Weights count by their ratios: a multiple of all of them repeats the same schedule."""
    given = [(name, weight * times) for name, weight in weights.items()]
    rows = mixing_pfair.period_schedule(spark.createDataFrame(given, "name string, weight int")).collect()
    least = math.gcd(*weights.values())
    reduced = {name: weight // least for name, weight in weights.items()}
    assert [r.name for r in sorted(rows, key=lambda r: r.slot)] == plain_pfair(reduced)
    assert {r.period for r in rows} == {sum(reduced.values())}


def test_pfair_schedule_of_fine_weights(spark):
    """Shares given as hundred-thousandths: no step may copy a list of the period's length."""
    weights = {"a": 33_331, "b": 27_773, "c": 19_997, "d": 18_899}
    given = spark.createDataFrame(list(weights.items()), "name string, weight int")
    began = time.monotonic()
    rows = mixing_pfair.period_schedule(given).collect()
    assert time.monotonic() - began < 30
    assert [r.name for r in sorted(rows, key=lambda r: r.slot)] == plain_pfair(weights)


def test_mixing_special_cases(spark):
    docs = odd_documents(spark)
    weights = spark.createDataFrame([("src1", 2), ("src3", 1)], "source string, weight int")
    placed = mixing_pfair.mix(docs, weights, block_rows=2, bucket_rows=3).toPandas()
    assert len(placed) == docs.count()
    assert (placed.groupby("slot").size() <= 2).all()
    assert placed.groupby("slot")["source"].nunique(dropna=False).max() == 1
    again = mixing_pfair.mix(docs.repartition(7), weights, block_rows=2, bucket_rows=100).toPandas()
    names = ["slot", "place", "doc_id"]
    assert placed[names].sort_values(names).values.tolist().__repr__() == again[names].sort_values(names).values.tolist().__repr__()
    assert mixing_pfair.mixed(docs, weights).columns == docs.columns
    assert mixing_pfair.mixed(docs, weights).count() == docs.count()
    assert mixing_pfair.mix(no_documents(spark), weights).collect() == []


def test_mixing_runs_no_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = mixing_pfair.mixed(docs, mixing_pfair.weights_by_rule(docs, F.lit(1)))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# ---------------------------------------------------------------- toxicity
MODEL = toxicity.ToxicityModel({"idio": 2.0, "moron": 2.0})


def weight(text):
    return toxicity.Matcher(MODEL).clause(text)


def test_grammar():
    assert weight("what a fine day") == 0
    assert weight("you idiot") > weight("the idiot") > weight("not an idiot") > 0
    assert weight("the idiot") > weight("someone said the idiot")
    assert weight("i will kill you") < weight("you i will kill")
    assert weight("idiot moron") > 2 * weight("idiot")
    following, factors = toxicity.compose()
    assert len(following) == len(factors) and max(map(max, following)) < len(following)


def test_only_word_beginnings_match():
    matcher = toxicity.Matcher(MODEL)
    assert matcher.matched("bidiot. An IDIOTIC day; moron") and len(matcher.matched("bidiot. An IDIOTIC day; moron")) == 2
    assert matcher.evidence(None) == matcher.evidence("") == matcher.evidence("xidiot") == (0.0, 0.0, 0.0)


def test_inflected_forms():
    assert toxicity.inflected("stab") == ["stab", "stabs", "stabbed", "stabbing"]
    assert toxicity.inflected("strangle") == ["strangle", "strangles", "strangled", "strangling"]
    assert toxicity.inflected("reply") == ["reply", "replies", "replied", "replying"]
    assert toxicity.inflected("poison")[2] == "poisoned" and toxicity.inflected("lynch")[1] == "lynches"
    assert weight("you they are killing") == weight("you they are kill") > 0
    assert weight("stable skill") == 0
    learned = toxicity.Matcher(toxicity.ToxicityModel({"kill": 0.5}))
    assert 0 < learned.clause("you kills") == 0.25 * weight("you kills")


def test_nested_beginnings_give_way_to_the_longest(spark):
    texts = [(i, f"well {'worthless' if i % 2 else 'common'} thing {i % 7}{'ab' * i}") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int"))
    assert "worthl" in model.stems and not {"wort", "worth"} & set(model.stems)
    assert toxicity.Matcher(model).clause("it is worth a walk") == 0


def plain_evidence(text, stems):
    """The grammar in plain words: no automaton, no product of machines, every clause read."""
    weights = []
    for clause in re.split(r"[.!?;:\n]+", text.lower()):
        total, insulted, threats, addressed, negated, reported = 0.0, False, 0, 0, 0, False
        for word in re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?", clause):
            beginnings = [word[:k] for k in (4, 5, 6) if k <= len(word)] or [word + " "]
            learned = max([stems[b] for b in beginnings if b in stems], default=0.0)
            threat = word in toxicity.THREATS
            listed = threat or word in toxicity.TARGETS + toxicity.NEGATIONS + toxicity.REPORTS
            known = 2.0 if word in toxicity.SEED_INSULTS or any(b in toxicity.SEED_INSULTS for b in beginnings) else 0.0
            insult = 0.0 if listed else max(learned or 0.0, known if not any(b in stems for b in beginnings) else 0.0)
            value = (learned or 2.0) if threat else insult
            if value:
                value *= 1.5 if insult and insulted else 1.0
                value *= 0.5 if threat and threats else 1.0
                value *= 2.0 if addressed else 0.25 if threat else 1.0
                value *= 0.4 if negated else 1.0
                value *= 0.6 if reported else 1.0
                total += value
            insulted, threats = bool(insult), threats + threat
            addressed = 4 if word in toxicity.TARGETS else max(0, addressed - 1)
            negated = 3 if word in toxicity.NEGATIONS else max(0, negated - 1)
            reported = reported or word in toxicity.REPORTS
        if total:
            weights.append(total)
    if not weights:
        return 0.0, 0.0, 0.0
    return math.log1p(sum(weights)), min(max(weights), 20.0), math.log1p(1000 * sum(weights) / (len(text) + 100))


def test_toxicity_by_a_plain_parser():
    random.seed(12)
    stems = {"vile": 1.25, "rott": 0.75, "kill": 0.5, "oaf ": 1.5}
    matcher = toxicity.Matcher(toxicity.ToxicityModel(stems))
    words = "vile Rotten idiot KILLING stabbed you isn't never said reported the stable oaf oafs day été 7idiot x_vile bidiot o'idiot trash".split()
    marks = [" "] * 8 + [". ", "!? ", "; ", ":\n", "\n", ", ", " - ", ""]
    found = 0
    for _ in range(3000):
        text = "".join(random.choice(words) + random.choice(marks) for _ in range(random.randint(0, 25)))
        assert matcher.evidence(text) == pytest.approx(plain_evidence(text, stems), abs=1e-9), text
        found += bool(matcher.evidence(text)[0])
    assert found > 2000


def test_toxicity_special_cases(spark):
    docs = odd_documents(spark)
    for labels in ([], [(1, 1)], [(1, None), (None, 1)]):
        model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert model == toxicity.ToxicityModel()
    scored = {r["doc_id"]: r for r in toxicity.score_documents(docs, MODEL).collect()}
    assert scored[7]["predicted"] == 1 and scored[3]["score"] == scored[4]["score"] < 0.5
    kept = toxicity.drop_toxic(docs, MODEL)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert toxicity.score_documents(no_documents(spark), MODEL).collect() == []


# -------------------------------------------------------------- co-training
def test_co_training_uses_both_views():
    generator = np.random.default_rng(2)
    y = (np.arange(400) % 2).astype(float)
    views = [generator.normal(size=(400, 4)) + y[:, None] * 2 for _ in (0, 1)]
    hidden = (np.arange(300) % 3 == 0).astype(float)
    pool = [generator.normal(size=(300, 4)) + hidden[:, None] * 2 for _ in (0, 1)]
    model = cotraining.co_train(views, y, pool)
    odds = (model.content.log_odds(pool[0]) + model.metadata.log_odds(pool[1])) / 2
    assert ((odds > 0) == hidden).mean() > 0.97


def test_views_are_separate():
    one = "Ab cd.\n\nef 12, gh!\nAb cd."
    other = "Zq xw.\n\nyy 98- pp!\nZq xw."  # other letters, digits and inner marks in the same layout
    assert (cotraining.metadata_view(one, "en", "a") == cotraining.metadata_view(other, "en", "a")).all()
    assert (cotraining.content_view(one) != cotraining.content_view(other)).any()
    assert (cotraining.metadata_view(one, "en", "a") != cotraining.metadata_view(one, "fr", "a")).any()
    assert (cotraining.metadata_view(one, "en", "a") != cotraining.metadata_view(one + "\n", "en", "a")).any()


def test_exchange_of_labels_helps():
    """Few labels, many unlabelled rows, two views that are independent given the class."""
    wrong = {0: 0, 3: 0}
    for seed in range(5):
        generator = np.random.default_rng(seed)

        def made(n, generator=generator):
            y = (np.arange(n) % 2).astype(float)
            return y, [generator.normal(size=(n, 40)) + 0.45 * y[:, None] for _ in (0, 1)]

        y, views = made(60)
        _, pool = made(1500)
        hidden, rest = made(1500)
        for rounds in wrong:
            model = cotraining.co_train(views, y, pool, rounds)
            odds = model.content.log_odds(rest[0]) + model.metadata.log_odds(rest[1])
            wrong[rounds] += int(((odds > 0) != hidden).sum())
    assert wrong[3] < wrong[0]


def test_quality_special_cases(spark):
    docs = odd_documents(spark)
    model = cotraining.learn(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert {r["score"] for r in cotraining.score_documents(docs, model).collect()} == {1.0}
    x = np.zeros((10, cotraining.CONTENT)), np.zeros((10, cotraining.META + 2 * cotraining.NAMED))
    linear = [cotraining.fit_linear(v, np.arange(10) % 2.0, np.ones(10), 1e-3, 5) for v in x]
    kept = cotraining.keep_good(docs, cotraining.QualityModel(*linear), threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert cotraining.score_documents(no_documents(spark), model).collect() == []


# ----------------------------------------------------------------- vectors
def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    values = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, -0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (7, [None, 1.0]), (8, [0.6, 0.8]), (20, [0.0, 2.0]), (None, [1.0, 1.0]), (40, [0.0, 1.0]), (9, []),
    ]
    made = spark.createDataFrame(values, "vec_id long, vector array<double>")
    return made.selectExpr("*", "1 AS entry", "2 AS code", "3 AS query", "4 AS VEC_")


def test_neighbours_special_cases(spark):
    found = cross_polytope.nearest(odd_vectors(spark), F.col("vec_id") % 20 == 0, k=3, tables=20, probes=4)
    by_query = {}
    for r in found.orderBy("query_id", "rank").collect():
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    assert by_query[0] == [(1, 1.0), (2, 1.0), (8, 0.6)]
    assert by_query[20] == [(40, 2.0), (8, 1.6), (0, 0.0)]
    empty = odd_vectors(spark).where("vec_id > 100")
    assert cross_polytope.nearest(empty, F.lit(True)).collect() == []


def test_hadamard_keeps_angles():
    x = np.random.default_rng(0).normal(size=(5, 64))
    y = cross_polytope.hadamard(x)
    assert np.allclose(x @ x.T, y @ y.T)
    assert np.allclose(cross_polytope.hadamard(y), x)


def test_exact_top_k_special_cases(spark):
    found = impact_index.top_k(odd_vectors(spark), F.col("vec_id") % 20 == 0, k=3, block_rows=2, block_queries=1)
    by_query = {}
    for r in found.orderBy("query_id", "rank").collect():
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert by_query[0] == [(1, 4096), (2, 4096), (8, 64 * 38)]
    assert by_query[20] == [(40, 8192), (8, 128 * 51), (0, 0)]
    assert impact_index.top_k(odd_vectors(spark).where("vec_id > 100"), F.lit(True)).collect() == []


def test_exact_top_k_keeps_large_components(spark):
    import duckdb

    rng = np.random.default_rng(6)
    wide = rng.normal(size=(60, 1024)) * 20
    wide[5:9] *= 1000
    for rows in ([[1.0, 0.0], [70000.0, 0.0], [0.5, 0.0], [0.25, 0.1], [-70000.0, 9.0]], wide.tolist(), [[1e15, 1.0], [1e15, 2.0], [-1e15, 0.5], [1.0, 1.0]]):
        made = spark.createDataFrame([(20 * i, v) for i, v in enumerate(rows)], "vec_id long, vector array<double>")
        found = sorted(map(tuple, impact_index.top_k(made, F.lit(True), k=3, block_rows=25, block_queries=30).collect()))
        whole = [[int(np.floor(64 * x)) for x in v] for v in rows]
        score = [[min(max(sum(x * y for x, y in zip(a, b)), -(1 << 63)), (1 << 63) - 1) for b in whole] for a in whole]
        want = []
        for i in range(len(rows)):
            best = sorted((-score[i][j], 20 * j) for j in range(len(rows)) if j != i)[:3]
            want += [(20 * i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
        assert found == sorted(want)
        if np.abs(rows).max() < 1e9:
            con = duckdb.connect()
            given = made.selectExpr("vec_id", "vector AS embedding").toPandas()  # noqa: F841
            assert sorted(con.execute(impact_index.oracle("given", "embedding", "{} >= 0", k=3)).fetchall()) == found


def test_impact_blocks_stop_only_on_proof():
    generator = np.random.default_rng(4)
    for spread in (1, 9, 40):
        x = np.rint(generator.normal(size=(500, 16)) * spread).astype(np.int64)
        x[100:160] = x[7]
        ids = generator.permutation(500)
        block = impact_index.ImpactBlock(x, ids)
        queries = x[:40]
        who, rows_, score = block.best(queries.astype(np.float64), 10)
        exact = queries @ x.T
        for q in range(40):
            best = np.lexsort((ids, -exact[q]))[:10]
            assert rows_[who == q].tolist() == best.tolist()
            assert score[who == q].tolist() == exact[q][best].tolist()


def test_stored_index_lies_in_small_pieces(spark):
    generator = np.random.default_rng(11)
    x = np.rint(generator.normal(size=(6000, 64)) * 8)
    x[17], x[18, 3] = 0, 70_000.0 * 64
    made = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    for build in (impact_index._build, lambda table: gnat._build(table.append_column("label", table.column("vec_id")))):
        held = {}
        for r in vector_blocks.block_index(made, 2, build, "pieces").orderBy("block", "piece").collect():
            assert len(r["index"]) <= vector_blocks.PIECE_BYTES
            held[r["block"]] = held.get(r["block"], b"") + r["index"]
        blocks = [pickle.loads(zlib.decompress(h)) for h in held.values()]
        assert sorted(i for b in blocks for i in b.ids.tolist()) == list(range(6000))
        assert all((b.vectors == x[b.ids]).all() and b.vectors.dtype == np.float64 for b in blocks)
    # a stored index takes about three bytes a component, whatever its segments
    made = impact_index.ImpactBlock(x[:4096], np.arange(4096))
    assert len(pickle.dumps(impact_index.ImpactBlock(x[100:4196], np.arange(4096)), protocol=5)) < 3 * 4096 * 64
    again = pickle.loads(pickle.dumps(made, protocol=5))
    for got, want in zip(again.best(x[:300], 9), made.best(x[:300], 9), strict=True):
        assert (got == want).all()


@pytest.mark.parametrize(("spread", "dim"), [(0.15, 16), (3, 40), (40_000, 5), (0.01, 6)])
def test_exact_top_k_over_runs_of_blocks(spark, spread, dim):
    generator = np.random.default_rng(dim)
    x = generator.normal(size=(1200, dim)) * spread
    x[generator.random(x.shape) < 0.3] = 0
    x[100:160], x[900:940], x[300:310] = x[7], -x[7], 0  # ties across blocks
    x[500, 0], x[777, 1] = 20_000, -3e15
    made = spark.createDataFrame([(5 * i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    found = impact_index.top_k(made, F.col("vec_id") % 50 == 0, k=6, block_rows=20, block_queries=50)
    whole = [[int(v) for v in row] for row in np.floor(64 * x)]
    want = []
    for i in range(0, 1200, 10):
        score = [min(max(sum(a * b for a, b in zip(whole[i], row, strict=True)), vector_blocks.LEAST), vector_blocks.MOST) for row in whole]
        best = sorted((-s, 5 * j) for j, s in enumerate(score) if j != i)[:6]
        want += [(5 * i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_best_rows_of_a_task():
    names = ["a", "b", "score", "row"]
    made = [(1, 2, 5, 9), (1, 2, 5, 3), (1, 2, 7, 8), (1, 3, -4, 1), (0, 9, vector_blocks.LEAST, 4), (0, 9, vector_blocks.MOST, 5), (1, 2, 5, 1)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in some]) for some in (made[:3], made[3:])]
    best = vector_blocks.Best(("a", "b"), "score", "row", 2)
    kept = best.of(batches)
    assert [tuple(r.values()) for r in kept.to_pylist()] == [made[5], made[4], made[2], made[6], made[3]]
    assert best.of([kept]).equals(kept)
    assert best.of([kept.slice(0, 0)]).num_rows == 0


# ------------------------------------------------------------- reply trees
def test_paths_and_ranking(spark):
    messages = [
        (1, 1, None, "user", "root", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 2.0),
        (1, 4, 3, "user", "c", 2.0), (1, 5, 99, "user", "lost", 9.0), (1, 6, 6, "user", "own", 0.0), (1, 6, 6, "user", "zzz", 0.0),
        (2, 1, 2, None, None, None), (2, 2, 1, "assistant", "d", 1.0), (None, 1, None, "user", "x", 1.0), (3, None, 1, "user", "y", 1.0),
    ]
    made = spark.createDataFrame(messages, "tree_id long, msg_id long, parent_id long, role string, text string, score double")
    made = made.selectExpr("*", "1 AS leaf", "2 AS up", "3 AS turns")
    found = reply_trees.read_formatted(reply_trees.format_trees(made)).collect()
    texts = {(r["tree_id"], r["branch"]): [t["text"] for t in r["turns"]] for r in found}
    assert texts == {(1, 1): ["lost"], (1, 2): ["root", "b", "c"], (1, 3): ["root", "a"], (1, 4): ["own"], (2, 1): ["", "d"]}
    best = reply_trees.format_trees(made, branches=1)
    assert {(r["tree_id"], r["leaf"]) for r in best.collect()} == {(1, 5), (2, 2)}
    assert reply_trees.format_trees(made.where("tree_id > 9")).collect() == []


def test_long_chain_and_escapes(spark):
    tricky = ["\\", "\\\\", "#", "\\#", "<", "</turn>\n", "\\l<", "### user: </turn>", "", "\\h\\l\\c:", "a: b\n", "\\" * 5 + "#"]
    turns = [(7, i, ("user", "assistant", "odd: ro#le<")[i % 3], tricky[i % len(tricky)]) for i in range(700)]
    made = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    read = reply_trees.read_formatted(reply_trees.format_trees(reply_trees.conversations_as_trees(made))).collect()
    assert len(read) == 1
    assert [(t["role"], t["text"]) for t in read[0]["turns"]] == [t[2:] for t in turns]
    assert read[0]["loss_texts"] == [t[3] for t in turns if t[2] == "assistant"]


# -------------------------------------------------------------------- urls
RULES = (url_templates.Rule("net", "/", "block"), url_templates.Rule("example.net", "/en/", "allow"))


def test_url_parts_and_rules(spark):
    urls = [
        (1, "http://A.Example.NET/en/x?y#z"), (2, "https://example.net#a/b"), (3, "x.net/en/"), (4, None), (5, "ftp://b.net/q"),
        (6, "http://example.network/en/"), (7, "://net/"), (8, "a://b://c/d"), (8, "a://b://c/d"), (None, "http://É.net/\n/x"),
        (9, "http://notexample.net/en/1"),
    ]
    pages = spark.createDataFrame(urls, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS n", "3 AS b1")
    labels = spark.createDataFrame([(None, 1), (1, None)], "key long, bad int")
    found = url_templates.judge_urls(pages, RULES, labels).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found}
    assert len(found) == len(urls)
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2] == ("example.net", "", None, "allow")
    assert got[3] == got[4] == ("", "", None, "allow")
    assert got[5] == ("b.net", "/q", "net/", "block")
    assert got[6] == ("example.network", "/en/", None, "allow")
    assert got[7] == ("net", "/", "net/", "block")
    assert got[8] == ("b:", "//c/d", None, "allow")
    assert got[None] == ("É.net", "/\n/x", "net/", "block")
    assert got[9] == ("notexample.net", "/en/1", "net/", "block")
    assert url_templates.judge_urls(pages.where("page_id > 99"), RULES, labels).collect() == []


def test_templates_generalise_and_reject(spark):
    pages = [(i, f"http://h.org/spam/{i}.html") for i in range(40)] + [(100 + i, f"http://h.org/news/{100 + i}") for i in range(40)]
    pages += [(1000 + i, f"http://v.org/u/name{chr(97 + i % 26)}{chr(97 + i // 26)}/{1000 + i}") for i in range(60)]
    labels = [(i, int(i < 40)) for i in range(140)]
    made = spark.createDataFrame(pages, "page_id long, url string")
    found = url_templates.judge_urls(made, (), spark.createDataFrame(labels, "key long, bad int")).collect()
    got = {r["page_id"]: (r["template"], r["verdict"]) for r in found}
    assert got[3] == ("/spam/{n}.html", "block")
    assert got[103] == ("/news/{n}", "allow")
    assert got[1000] == got[1059] == ("/u/*/{n}", "allow")


def test_a_bad_directory_among_many_keeps_its_branch(spark):
    pages = [(i, f"http://h.org/{chr(97 + i % 30 // 26)}{chr(97 + i % 30 % 26)}/{i}") for i in range(3000)]
    labels = [(i, int(i % 30 == 7)) for i in range(3000)]
    made = spark.createDataFrame(pages, "page_id long, url string")
    found = url_templates.judge_urls(made, (), spark.createDataFrame(labels, "key long, bad int")).collect()
    got = {r["page_id"]: (r["template"], r["verdict"]) for r in found}
    assert {got[i] for i in range(3000) if i % 30 == 7} == {("/ah/{n}", "block")}
    assert {got[i] for i in range(3000) if i % 30 != 7} == {("/*/{n}", "allow")}


# ------------------------------------------- inputs that once took too long or went wrong
def test_words_of_any_structure_differ(spark):
    swap = str.maketrans("ab", "ba")
    word = "a"
    while len(word) < 4096:
        word += word.translate(swap)
    rows = [(1, word), (2, word.translate(swap)), (3, word), (4, f"{word} {word} x"), (5, f"{word.translate(swap)} {word} x")]
    found = ngram_jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_neighbours_with_equal_scores(spark):
    rng = np.random.default_rng(0)
    rows = [(0, [1.0, 0.0, 0.0, 0.0])]
    ids = rng.permutation(np.arange(1, 301)).tolist()
    for n, i in enumerate(ids):
        angle = rng.random() * 6.28
        side = [float(np.cos(angle)), float(np.sin(angle)), 0.0]
        rows.append((i, [0.95 if n < 10 else 0.9 if n < 240 else 0.85, *(0.2 * c for c in side)]))
    found = cross_polytope.nearest(spark.createDataFrame(rows, "vec_id long, vector array<double>"), F.col("vec_id") == 0, k=20)
    want = sorted(ids[:10]) + sorted(ids[10:240])[:10]
    assert [r["vec_id"] for r in found.orderBy("rank").collect()] == want


def test_toxicity_takes_long_texts():
    import time

    matcher = toxicity.matcher_of(toxicity.ToxicityModel(stems={"idiot": 2.0}))
    short = "you are an idiot, and so on; he said no idiot here!! idiot"
    assert [short[a:b] for a, b, _ in matcher.matched(short)] == ["you are an idiot, and so on", " he said no idiot here", " idiot"]
    begun = time.time()
    words = "you are an idiot and so on and on. " * 290_000  # ten million characters, a hit in every clause
    assert len(matcher.matched(words)) == 290_000
    assert 0 <= matcher.score(words.replace(".", " ")) <= 1
    assert time.time() - begun < 40


def test_long_urls_and_one_bad_directory(spark):
    import time

    import duckdb

    rules = (url_templates.Rule("net", "/", "block"),)
    pages = [(1, "http://a.org/" + "7" * 1_000_000), (2, "http://a.org/" + "7a" * 500_000), (3, None), (4, "http://a.org/x/9")]
    labels = spark.createDataFrame([(9, 1)], "key long, bad int")
    begun = time.time()
    found = url_templates.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), rules, labels)
    assert found.count() == 4 and time.time() - begun < 30
    # 30 even directories, one of them all bad: the operator and its SQL agree, and both block it
    pages = [(100 * d + i, f"http://a.org/dir{chr(97 + d % 26)}{chr(97 + d // 26)}/{100 * d + i}") for d in range(30) for i in range(100)]
    given = spark.createDataFrame(pages, "page_id long, url string")
    truth = [(100 * d + i, int(d == 7)) for d in range(30) for i in range(100)]
    found = url_templates.judge_urls(given, rules, spark.createDataFrame(truth, "key long, bad int")).drop("purity")
    con = duckdb.connect()
    frame, bad = given.toPandas(), spark.createDataFrame(truth, "key long, bad int").toPandas()  # noqa: F841
    con.execute("CREATE VIEW pages AS SELECT * FROM frame")
    sql = con.execute(url_templates.oracle(rules, "SELECT * FROM bad"))
    names = [c[0] for c in sql.description]
    want = sorted(tuple(str(r[names.index(c)]) for c in found.columns) for r in sql.fetchall())
    assert sorted(tuple(map(str, r)) for r in found.collect()) == want
    assert found.where("verdict = 'block'").count() == 100
