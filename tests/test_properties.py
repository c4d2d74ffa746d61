"""Operators against brute force on small, skewed inputs, and independence of partitioning."""

import contextlib
import io
import math
import random
import time
from collections import Counter
from itertools import groupby

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom import schemas
from textloom.operators import chunking, export, langid, mixing, ordering, records, shaping
from textloom.options import ChunkOptions, CleanOptions
from textloom.session import spread
from workload.queries import QUERIES


def plan_text(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def skewed(seed, rows):
    """Rows of which one key holds a third, with clustered keys."""
    rng = random.Random(seed)
    keys = ["hot"] * (rows // 3) + [f"k{rng.randrange(8)}" for _ in range(rows - rows // 3)]
    rng.shuffle(keys)
    places = sorted(rng.sample(range(rows), rows // 2) + rng.sample(range(10**12, 10**12 + rows), rows - rows // 2))
    return list(zip(places, keys))


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_dense_index(spark, buckets):
    rows = skewed(1, 300)
    df = spark.createDataFrame(rows, "at long, key string").repartition(5)
    placed = ordering.range_bucket(df, "at", "_b", buckets)
    indexed = ordering.dense_index(placed, ["_b"], ["at"], "i").collect()
    assert sorted((r.i, r["at"]) for r in indexed) == list(enumerate(sorted(at for at, _ in rows)))
    sizes = [r["count"] for r in placed.groupBy("_b").count().collect()]
    assert max(sizes) <= max(2 * 300 // buckets, 10)


def test_exclusive_prefix_of_several_sums(spark):
    rows = [(i, i % 7, i * i) for i in range(200)]
    df = spark.createDataFrame(rows, "at long, a long, b long").repartition(4)
    placed = ordering.range_bucket(df, "at", "_b", 9)
    got = {r["at"]: (r.pa, r.pb) for r in ordering.exclusive_prefix(placed, ["_b"], ["at"], {"pa": F.col("a"), "pb": F.col("b")}).collect()}
    assert got == {i: (sum(a for _, a, _ in rows[:i]), sum(b for _, _, b in rows[:i])) for i in range(200)}


@pytest.mark.parametrize("fanout", [2, 7, 10_000])
def test_sums_over_sums(spark, monkeypatch, fanout):
    monkeypatch.setattr(ordering, "FANOUT", fanout)
    rows = [(f"s{i % 3}", i // 3, i % 5, i) for i in range(60)]
    df = spark.createDataFrame(rows, "s string, b int, n int, m long").repartition(5)
    got = ordering.running_totals(df, ["s", "b"], ["n", "m"]).collect()
    rows.sort()
    expected = {(s, b): (sum(r[2] for r in rows[:i]), sum(r[3] for r in rows[:i])) for i, (s, b, _, _) in enumerate(rows)}
    assert {(r.s, r.b): (r._offset_n, r._offset_m) for r in got} == expected


def plans_of(spark, action):
    """The plans of all jobs of ``action``, as text."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    action()
    time.sleep(0.5)  # events arrive a little later
    done = store.executionsList()
    return [done.apply(i).physicalPlanDescription() for i in range(int(before), done.size())]


def test_no_single_task_and_one_text_scan(spark, sf_dir):
    for name in ("chunk_ids", "shard_assign", "src_run_concat", "src_run_concat_lines", "dense_index"):
        plans = plans_of(spark, lambda name=name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
        assert len(plans) > 1
        for plan in plans:
            assert "Window" not in plan or "SinglePartition" not in plan, plan  # totals of one row are no window
        last = plans[-1]
        scans = [line for line in last.splitlines() if line.startswith("ReadSchema") and "text:" in line]
        assert len(scans) == 1, last


@pytest.mark.parametrize("limit", [0, 1, 2, 37, 99, 100, 101, 10**6, None])
def test_first_per_group(spark, limit):
    rows = skewed(2, 300)
    df = ordering.range_bucket(spark.createDataFrame(rows, "at long, key string").repartition(5), "at", "_b", 7)
    limits = spark.createDataFrame([("hot", limit), ("k1", 2)], "key string, max_rows long")
    got = ordering.first_per_group(df, "key", ["_b"], ["at"], limits).collect()
    expected = []
    for key in {k for _, k in rows}:
        mine = sorted(at for at, k in rows if k == key)
        n = {"hot": limit, "k1": 2}.get(key)
        expected += [(at, key) for at in (mine if n is None else mine[:n])]
    assert sorted((r["at"], r.key) for r in got) == sorted(expected)


@pytest.mark.parametrize("costly", [False, True])
def test_paths_beyond_the_broadcast_bound_agree(spark, monkeypatch, costly):
    rows = skewed(4, 300)
    df = ordering.range_bucket(spark.createDataFrame(rows, "at long, key string"), "at", "_b", 7)
    limits = spark.createDataFrame([("hot", 40), ("k1", 0), ("k2", 3)], "key string, max_rows long")
    cut = lambda: ordering.first_per_group(df, "key", ["_b"], ["at"], limits, costly)
    joined = lambda: ordering.join_small(df, limits, ["key"], "left")
    small = [sorted(map(repr, q().collect())) for q in (cut, joined)]
    monkeypatch.setattr(ordering, "BROADCAST_ROWS", 0)
    assert [sorted(map(repr, q().collect())) for q in (cut, joined)] == small
    assert "ResolvedHint" not in plan_text(joined()) and len(small[0]) < len(small[1]) == 300


def brute_runs(lines, min_chars):
    lines = [(at, book, text.strip()) for at, book, text in sorted(lines) if text.strip()]
    out = []
    for book, run in groupby(lines, key=lambda line: line[1]):
        run = list(run)
        text = " ".join(line for _, _, line in run)
        if len(text) >= min_chars:
            out.append((run[0][0], book, text))
    return out


@pytest.mark.parametrize("seed,buckets", [(s, b) for s in range(4) for b in (1, 4, 25)])
def test_concat_runs(spark, seed, buckets):
    rng = random.Random(seed)
    lines, book = [], 0
    for at in range(200):
        # long runs cover several buckets; some books are null
        if rng.random() < (0.02 if seed % 2 else 0.4):
            book = rng.choice([1, 2, 3, None])
        lines.append((at, book, rng.choice(["", " \t", f" line {at} ", f"l{at}"])))
    df = spark.createDataFrame(lines, "at long, book long, line string").repartition(6)
    placed = ordering.range_bucket(df, "at", "_b", buckets)
    got = shaping.concat_runs(placed, "book", "line", ["_b"], ["at"], min_chars=10)
    assert sorted((r.start["at"], r.book, r.text) for r in got.collect()) == brute_runs(lines, 10)


@pytest.mark.parametrize("fanout", [2, 10_000])
@pytest.mark.parametrize("buckets", [1, 4, 60])
def test_run_lines_give_the_joined_texts(spark, monkeypatch, buckets, fanout):
    """Runs over many buckets, null ids and lines, blank lines; the lines in their order are the joined text."""
    monkeypatch.setattr(ordering, "FANOUT", fanout)
    rng = random.Random(buckets)
    books, book = [], 0
    while len(books) < 400:
        book = rng.choice([None, 1, 2, 3])
        books += [book] * rng.choice([1, 2, 5, 5, 60])
    rows = [(i * 3, b, rng.choice([None, "", "  ", f" l{i} ", "x", "字 y"])) for i, b in enumerate(books)]
    df = spark.createDataFrame(rows, "at long, book long, line string").repartition(4)
    placed = ordering.range_bucket(df, "at", "_b", buckets)
    args = ("book", "line", ["_b"], ["at"])
    whole = {r.start["at"]: (r.book, r.text) for r in shaping.concat_runs(placed, *args, min_chars=8).collect()}
    lines = {}
    for r in shaping.run_lines(placed, *args, min_chars=8).collect():
        lines.setdefault(r.start["at"], []).append((r.position, r.book, r.line))
    assert len(whole) > 3 and lines.keys() == whole.keys()
    for at, found in lines.items():
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert (found[0][1], " ".join(line for _, _, line in found)) == whole[at]


@pytest.mark.parametrize("fanout", [2, 10_000])
def test_group_lines_give_the_joined_texts(spark, monkeypatch, fanout):
    monkeypatch.setattr(ordering, "FANOUT", fanout)
    rng = random.Random(5)
    keys = ["hot"] * 80 + [f"k{rng.randrange(9)}" for _ in range(140)] + [None] * 20
    rng.shuffle(keys)
    rows = [(i, key, rng.choice([None, "", f" l{i} ", "x"]), rng.choice(["en", "de", None])) for i, key in enumerate(keys)]
    df = spark.createDataFrame(rows, "at long, key string, line string, lang string").repartition(4)
    placed = ordering.range_bucket(df, "at", "_b", 11)
    args = ("key", "line", "lang", ["_b"], ["at"])
    whole = {(r.key, r.start["at"]): (r.lang, r.text) for r in shaping.concat_groups(placed, *args, min_chars=6).collect()}
    lines = {}
    for r in shaping.group_lines(placed, *args, min_chars=6).collect():
        lines.setdefault((r.key, r.start["at"]), []).append((r.position, r.lang, r.line))
    assert len(whole) > 8 and lines.keys() == whole.keys()
    for at, found in lines.items():
        found.sort(key=lambda f: f[0])
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert (found[0][1], "\n".join(line for _, _, line in found)) == whole[at]


def test_lines_of_nothing(spark):
    none = spark.createDataFrame([], "at long, key string, line string, lang string").withColumn("_b", F.lit(0))
    assert shaping.run_lines(none, "key", "line", ["_b"], ["at"]).count() == 0
    assert shaping.group_lines(none, "key", "line", "lang", ["_b"], ["at"]).count() == 0


def test_lines_without_a_group_stay_in_their_bucket(spark):
    rows = [(i, i // 10, None, f"line {i}", "en") for i in range(40)]
    df = spark.createDataFrame(rows, "at int, _b int, key string, line string, lang string")
    got = shaping.concat_groups(df.repartition(3), "key", "line", "lang", ["_b"], ["at"], min_chars=1).collect()
    assert sorted(r.text.count("\n") + 1 for r in got) == [10] * 4


def test_concat_groups_spreads_a_hot_group(spark):
    rows = [(at, key, "en" if at % 2 else "de", f" {at} ") for at, key in skewed(3, 240)]
    df = ordering.range_bucket(spark.createDataFrame(rows, "at long, key string, lang string, line string"), "at", "_b", 8)
    got = shaping.concat_groups(df.repartition(3), "key", "line", "lang", ["_b"], ["at"], min_chars=1)
    expected = []
    for key in {r[1] for r in rows}:
        mine = sorted(r for r in rows if r[1] == key)
        expected.append((mine[0][0], key, mine[0][2], "\n".join(str(r[0]) for r in mine)))
    assert sorted((r.start["at"], r.key, r.lang, r.text) for r in got.collect()) == sorted(expected)


def test_keep_first_by_hash_limits_before_the_shuffle(spark):
    rows = [(i, "copy" if i % 3 == 0 else f"t{i % 50}") for i in range(300)]
    kept = shaping.keep_first_by_hash(spark.createDataFrame(rows, "at long, text string").repartition(5), "text", ["at"])
    first = {}
    for at, text in rows:
        first.setdefault(text, at)
    assert {r.text: r["at"] for r in kept.collect()} == first
    plan = plan_text(kept, "simple")
    assert plan.index("Partial") > plan.index("Exchange") > plan.index("WindowGroupLimit")


def test_cut_at_marker(spark):
    body = "word " * 30
    rows = [
        (0, "en", f"  {body}\n  References and more\n{body}"),
        (1, "en", f"{body}\nx References\n{body}"),
        (2, "xx", f"{body}\nSiehe auch\n{body}"),
        (3, "en", f"{body}\nSiehe auch"),
        (4, "en", f"Notes\n{body}"),
        (5, None, f"{body}\nSee also"),
        (6, "en", "short"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {r.doc_id: r.text for r in shaping.cut_at_marker(df, {"en": ["References", "Notes"]}, ["Siehe auch", "See also"]).collect()}
    b = body.strip()
    assert got == {0: b, 1: f"{body}\nx References\n{b}", 2: b, 3: f"{body}\nSiehe auch", 5: b}


def test_null_texts_count_as_empty(spark):
    df = spark.createDataFrame([(1, None, "x" * 120), (2, "y" * 120, None)], "doc_id long, a string, b string")
    got = shaping.unpivot_texts(df, {"a": "ru", "b": "en"}).collect()
    assert sorted((r.doc_id, r.part, r.lang) for r in got) == [(1, 1, "en"), (2, 0, "ru")]


def test_nested_texts_without_parts(spark):
    schema = "doc_id long, description string, parts array<struct<clean_text: string>>"
    df = spark.createDataFrame([(1, "d" * 100, None), (2, None, [(None,), ("p" * 100,)])], schema)
    got = shaping.nested_texts(df, "description", "parts", "clean_text", "ru").collect()
    assert sorted((r.doc_id, r.part) for r in got) == [(1, 0), (2, 2)]


# ------------------------------------------------------------------- chunks
OPTIONS = ChunkOptions(target_tokens=10, stride_tokens=7, min_tokens=3, max_chunks=5, safety_margin=1.3)


def brute_chunks(text, target, stride, shortest, most):
    windows = (text[i : i + target] for i in range(0, len(text), stride))
    return [w for w in windows if len(w) >= shortest][:most]


def test_chunks_against_brute_force(spark):
    texts = ["", "я" * 11, "ab😀" * 3, *("".join(chr(97 + (i * j) % 26) for j in range(i)) for i in range(0, 400, 7))]
    rows = [(i, lang, t) for i, (lang, t) in enumerate((lang, t) for t in texts for lang in ("en", "ru", "xx", None))]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {}
    for r in chunking.chunk_rows(df, OPTIONS).orderBy("doc_id", "k").collect():
        got.setdefault(r.doc_id, []).append(r.text)
        assert r.char_count == len(r.text)
    for doc_id, lang, text in rows:
        cpt = 6.0 if lang == "en" else 4.0
        expected = brute_chunks(text, int(10 * cpt * 1.3), int(7 * cpt), int(3 * cpt), 5)
        assert got.get(doc_id, []) == expected


def test_default_budgets(spark):
    df = spark.createDataFrame([("ru",), ("en",), ("de",), (None,)], "lang string")
    got = df.select("lang", chunking.chunk_budgets(F.col("lang"), ChunkOptions()).alias("b")).collect()
    assert {r.lang: tuple(r.b) for r in got} == {
        "ru": (2355, 1792, 512), "en": (3532, 2688, 768), "de": (2355, 1792, 512), None: (2355, 1792, 512)
    }


def test_windows_shorter_than_the_minimum_give_nothing(spark):
    options = ChunkOptions(target_tokens=1, stride_tokens=1, min_tokens=5)
    df = spark.createDataFrame([(1, "en", "x" * 100)], "doc_id long, lang string, text string")
    assert chunking.chunk_rows(df, options).count() == 0


def test_chunks_rebuild_the_document(spark, sf_dir):
    options = ChunkOptions(max_chunks=10_000, min_tokens=1, chars_per_token={}, default_chars_per_token=1.0)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    parts = {}
    for r in chunking.chunk_rows(docs, options).orderBy("doc_id", "k").collect():
        parts.setdefault(r.doc_id, []).append(r.text)
    for r in docs.collect():
        chunks = parts[r.doc_id]
        assert "".join(c[:448] for c in chunks[:-1]) + chunks[-1] == r.text


def documents(spark, sf_dir, partitions):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").drop("n_chars").withColumn("part", F.lit(0))
    return docs.repartition(partitions)


@pytest.fixture(scope="module")
def plan_of(spark):
    def plan(docs, rules):
        counts = docs.groupBy("source").agg(F.count("*").alias("num_records"))
        sources = counts.select("source", F.lit(1).alias("tier"), F.lit("text").alias("content_type"))
        return mixing.mix_plan(sources, counts, spark.createDataFrame(rules, schemas.RULE))

    return plan


def test_numbering_does_not_depend_on_partitions(spark, sf_dir, plan_of):
    results = []
    for partitions in (1, 8):
        docs = documents(spark, sf_dir, partitions)
        sampled = mixing.mix_sample(docs, plan_of(docs, [("src1", False, 0.02)]), 7)
        numbered = chunking.number_chunks(sampled, ["source", "_bucket"], ["_hash", "doc_id", "part"], ChunkOptions())
        results.append(sorted(map(tuple, numbered.select("id", "doc_id", "k", "byte_start").collect())))
    assert results[0] == results[1]
    assert [r[0] for r in results[0]] == list(range(len(results[0])))


def test_proportion_of_zero_takes_nothing(spark, sf_dir, plan_of):
    docs = documents(spark, sf_dir, 2)
    sampled = mixing.mix_sample(docs, plan_of(docs, [("src1", False, 0.0)]), 7)
    assert {r.source for r in sampled.select("source").distinct().collect()} == {f"src{i}" for i in range(20) if i != 1}


def test_shuffle_keeps_all_rows_and_orders_partitions(spark, sf_dir):
    docs = documents(spark, sf_dir, 3).select("doc_id", "text")
    shuffled = export.global_shuffle(docs, 3, ["doc_id"], partitions=4)
    rows = shuffled.withColumn("h", ordering.seeded_hash(3, "doc_id")).withColumn("p", F.spark_partition_id()).collect()
    assert sorted(map(lambda r: (r.doc_id, r.text), rows)) == sorted(map(tuple, docs.collect()))
    assert [(r.p, r.h) for r in rows] == sorted((r.p, r.h) for r in rows)
    assert [r.h for r in rows] == sorted(r.h for r in rows)
    assert len({r.p for r in rows}) == 4


def test_shards_hold_the_target_within_one_row(spark, sf_dir):
    docs = mixing.with_shuffle_order(documents(spark, sf_dir, 3), 1)
    numbered = chunking.number_chunks(docs, ["source", "_bucket"], ["_hash", "doc_id", "part"], ChunkOptions())
    rows = numbered.select(
        export.shard_number(F.col("byte_start"), 20_000).alias("shard"), F.octet_length("text").alias("n")
    )
    shards = rows.groupBy("shard").agg(F.sum("n").alias("total"), F.max("n").alias("largest")).orderBy("shard").collect()
    assert len(shards) > 3
    assert all(abs(s.total - 20_000) <= s.largest + max(t.largest for t in shards) for s in shards[:-1])


def test_compression_ratio(spark, sf_dir, tmp_path):
    chunks = chunking.chunk_rows(documents(spark, sf_dir, 2), ChunkOptions())
    chunks.write.partitionBy("lang").parquet(f"{tmp_path}/full")
    measured = export.compression_ratio(spark, f"{tmp_path}/full").first()
    assert measured.rows == chunks.count() and measured.ratio == measured.raw_bytes / measured.parquet_bytes > 1.0
    assert measured.parquet_bytes == sum(p.stat().st_size for p in tmp_path.rglob("full/**/*.parquet"))
    chunks.where("false").write.parquet(f"{tmp_path}/none")
    assert export.compression_ratio(spark, f"{tmp_path}/none").first().ratio == 1.0


# ----------------------------------------------------------------- language
def brute_languages(labelled, texts):
    """Every trigram on its own, in plain Python."""
    def slots(text):
        t = text.lower()
        return [(ord(a) * 104_729 + ord(b) * 1_299 + ord(c)) % 262_139 for a, b, c in zip(t, t[1:], t[2:])]

    counts = {}
    for lang, text in labelled:
        if lang is not None and text is not None and len(text) >= 3:
            counts.setdefault(lang, Counter()).update(slots(text))
    used = {slot for c in counts.values() for slot in c}
    out = []
    for text in texts:
        known = [slot for slot in slots(text or "") if slot in used]
        scores = [
            (-sum(math.floor(math.log((c[slot] + 1) / (c.total() + len(used))) * 1_000_000) for slot in known), lang) for lang, c in counts.items()
        ]
        out.append(min(scores)[1] if known else "unknown")
    return out


ODD_TEXTS = ["", None, "ab", "字字字字", "\U0001F600\U0001F600\U0001F600", "aaa", "the THE"]


def test_language_model_against_brute_force(spark, sf_dir, tmp_path):
    some = [(r.lang, r.text[:300]) for r in documents(spark, sf_dir, 4).orderBy("doc_id").limit(12).collect()]
    labelled = [*some, (None, "no label"), ("en", None), ("en", ""), ("tiny", "ab"), ("en", "the the the")]
    schema = "lang string, text string"
    langid.save(langid.train(spark.createDataFrame(labelled, schema).repartition(3)), f"{tmp_path}/model")
    texts = [*ODD_TEXTS, *[text[20:80] for _, text in some]]
    numbered = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = langid.stored_detector(f"{tmp_path}/model")(numbered, ["doc_id"])
    assert [r.detected for r in got.orderBy("doc_id").collect()] == brute_languages(labelled, texts)
    assert "Exchange" not in plan_text(got)


def test_language_model_edges(spark, tmp_path):
    texts = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    empty = langid.train(spark.createDataFrame([], "lang string, text string"))
    langid.save(empty, f"{tmp_path}/empty")
    assert {r.detected for r in langid.stored_detector(f"{tmp_path}/empty")(texts, ["doc_id"]).collect()} == {"unknown"}
    dirty = spark.createDataFrame([(f"label {i}", "abc") for i in range(5)], "lang string, text string")
    assert len(langid.train(dirty, most_languages=5).languages) == 5
    with pytest.raises(ValueError, match="more than 4 languages"):
        langid.train(dirty, most_languages=4)
    spark.createDataFrame([(0, 7, ["en"])], "format int, slots int, languages array<string>").write.parquet(f"{tmp_path}/old/model")
    with pytest.raises(ValueError, match="not a language model"):
        langid.load(spark, f"{tmp_path}/old")


def test_language_detection_held_out(spark, sf_dir):
    """Labels of documents the model has not seen."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text").where("lang is not null")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = langid.detect(docs.where(held_out), langid.train(docs.where(~held_out)))
    right, n = found.agg(F.avg((F.col("lang") == F.col("detected")).cast("int")), F.count("*")).first()
    assert n > 20 and right > 0.8


# ------------------------------------------------------------------ schemas
def test_projection_drops_extras_and_fills_gaps(spark):
    schema = "type string, doc_id int, messages array<struct<content: string, extra: int, role: string>>"
    df = spark.createDataFrame([("dialogue", 5, [("hi", 1, "user")])], schema)
    out = schemas.project(df, schemas.DIALOGUE)
    assert out.schema == T.StructType([T.StructField(f.name, f.dataType) for f in schemas.DIALOGUE])
    row = out.first()
    assert (row.doc_id, row.lang, [tuple(m) for m in row.messages]) == (5, None, [("user", "hi")])


def test_spread_leaves_well_split_tables_alone(spark):
    wide = spark.range(100).repartition(spark.sparkContext.defaultParallelism)
    assert spread(wide, "id") is wide
    assert spread(spark.range(10).coalesce(1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_language_filter_reaches_the_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").drop("n_chars")
    text = plan_text(records.clean_records(docs, CleanOptions(("en",))))
    assert "EqualTo(lang,en)" in text or "In(lang" in text
    assert "n_chars" not in text.split("ReadSchema")[1].splitlines()[0]
    assert "Exchange" not in text
    assert text.count("ArrowEvalPython") == 2  # one node: tree line and details
