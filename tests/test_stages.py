"""The three stages end to end on landed files, and the sinks they use."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests import fixed_records as R
from textloom import schemas
from textloom.operators.ordering import seeded_hash
from textloom.operators.records import clean_records
from textloom.options import AssemblyOptions, ChunkOptions, CleanOptions
from textloom.plans.assemble import run_assembly
from textloom.plans.clean import run_clean
from textloom.plans.extract import run_extract
from textloom.plans import extract
from textloom.plans.layout import WHOLE, Layout
from textloom.sources import parquet_io
from textloom.sources import catalog
from textloom.sources.catalog import SourceSpec, builtin_sources
from textloom.sources.manifest import load_manifest, latest_results, select_sources
from textloom.streaming.clean_stream import clean_stream


def long(word, n=30):
    return (word + " ") * n


def land(spark, root):
    """Small landed files for every built-in source."""

    def put(name, rows, schema, **options):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}", **options)

    put("book_summaries", [(long("книга"), "кратко"), (long("том"), long("итог"))], "`Full Text` string, Summary string")
    put("chemistry_shelves", [(long("atom"),), ("short",), (None,)], "text string")
    put("fantasy_texts", [(long("дракон"),)], "text string")
    put("fan_fiction", [(long("опис"), [(long("глава"),), ("мало",)])], "description string, parts array<struct<clean_text: string>>")
    poem = [(1, f" line {i} of the first poem ") for i in range(8)] + [(2, ""), (1, "and on"), (2, "too short")]
    put("poetry_lines", [*poem, *[(1, f"line {i} of its return") for i in range(8)]], "gutenberg_id long, line string")
    put("story_pairs", [(long("рассказ"), long("story"), long("суть"), "gist")], "text_ru string, text_en string, summary_ru string, summary_en string")
    put("stories", [(long(f"answer{i}"), long("prompt")) for i in range(3)], "completion string, prompt_problem_solving_story string")
    put("subtitles", [(f"f{i % 2}", f"реплика номер {i}", "ru") for i in range(20)], "file_id string, text string, language string")
    put("toki_pona", [(long("toki"),)], "translated_text string")
    put("wiki_reading", [(long("reading"),), (long("чтение"),)], "text string")
    articles = [(long("article") + "\nSee also\nother", "en"), (long("статья"), "ru"), (long("artikel"), "xx")]
    spark.createDataFrame(articles, "text string, lang string").write.partitionBy("lang").parquet(f"{root}/encyclopedia")


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landed"))
    land(spark, root)
    return root


EXTRACTED = {
    "book_summaries": 3, "chemistry_shelves": 1, "fantasy_texts": 1, "fan_fiction": 2, "poetry_lines": 2,
    "story_pairs": 3, "stories": 4, "subtitles": 2, "toki_pona": 1, "wiki_reading": 2, "encyclopedia": 3,
}


def debug_sources():
    """The debug records as sources of both content types."""

    def texts(spark, _):
        return spark.createDataFrame([(i, 0, *r) for i, r in enumerate(R.TEXTS)], schemas.TEXT)

    def dialogues(spark, _):
        return spark.createDataFrame([(i, *r) for i, r in enumerate(R.DIALOGUES)], schemas.DIALOGUE)

    return [SourceSpec("debug_text", 1, "text", texts), SourceSpec("debug_dialogue", 1, "dialogue", dialogues)]


def test_builtin_sources(spark, landed, tmp_path):
    layout = Layout(str(tmp_path))
    detected = lambda df, keys: df.withColumn(
        "detected", F.when(F.col("text").rlike("[a-z]"), "en").otherwise("ru")
    )
    assert run_extract(spark, builtin_sources(detected), landed, layout) == EXTRACTED
    raw = spark.read.parquet(layout.raw("text"))
    by = lambda name: sorted((r.lang, r.text) for r in raw.where(F.col("source") == name).collect())
    first, second = [t for _, t in by("poetry_lines")]
    assert first.startswith("line 0 of its return") and second.endswith("first poem and on")
    assert [t for t in by("subtitles")] == [
        ("ru", "\n".join(f"реплика номер {i}" for i in range(start, 20, 2))) for start in (0, 1)
    ]
    assert [lang for lang, _ in by("wiki_reading")] == ["en", "ru"]
    assert by("encyclopedia") == [("en", long("article").strip()), ("ru", long("статья").strip()), ("xx", long("artikel").strip())]
    assert by("toki_pona")[0][0] == "tok"
    manifest = {r.source: r for r in load_manifest(spark, layout.manifest).collect()}
    assert {name: r.num_records for name, r in manifest.items()} == EXTRACTED
    assert manifest["story_pairs"].languages == ["en", "ru"]


def test_keys_do_not_depend_on_splits(spark, landed, tmp_path):
    """The same landed files give the same records and keys, however the scan is split."""
    found = []
    for size in ("1000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        layout = Layout(f"{tmp_path}/{size}")
        try:
            run_extract(spark, builtin_sources(), landed, layout)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        raw = spark.read.parquet(layout.raw("text"))
        found.append(sorted(map(tuple, raw.select("source", "doc_id", "part", "lang", "text").collect())))
        assert raw.select("source", "doc_id", "part").distinct().count() == raw.count()
    assert found[0] == found[1]
    assert {row[3] for row in found[0] if row[0] == "wiki_reading"} == {"en", "ru"}


def test_partitions_are_pruned_in_a_landed_source(spark, landed):
    rows = catalog.landed(spark, f"{landed}/encyclopedia", "text string, lang string").where("lang = 'en'")
    plan = rows._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(lang" in plan


def test_debug_sources_through_all_stages(spark, tmp_path):
    layout, specs = Layout(str(tmp_path)), debug_sources()
    assert run_extract(spark, specs, "unused", layout) == {"debug_text": 8, "debug_dialogue": 7}
    assert run_clean(spark, specs, layout) == {
        "debug_text": {"input": 8, "output": 5}, "debug_dialogue": {"input": 7, "output": 6}
    }
    results = {(r.source, r.stage): r for r in latest_results(load_manifest(spark, layout.manifest)).collect()}
    assert results["debug_text", "cleaning"].languages == ["en", "ru"]
    assert results["debug_dialogue", "cleaning"].languages == ["en", "ru"]

    # done stages are skipped, unless forced
    assert run_extract(spark, specs, "unused", layout) == {}
    assert run_clean(spark, specs, layout) == {}
    assert run_clean(spark, specs[:1], layout, force=True)["debug_text"]["output"] == 5

    # texts this short give no chunk at the default sizes, and an empty table
    assert run_assembly(spark, specs, layout) == 0
    assert parquet_io.count_rows(spark, layout.dataset) == 0

    small = AssemblyOptions(
        chunking=ChunkOptions(target_tokens=8, stride_tokens=7, min_tokens=2), shard_bytes=300
    )
    total = run_assembly(spark, specs, layout, options=small)
    chunks = spark.read.parquet(layout.dataset).select("*", "_metadata.file_name", "_metadata.row_index")
    chunks = chunks.orderBy("file_name", "row_index").collect()
    assert sorted(r.id for r in chunks) == list(range(total)) and total > 20
    assert {r.source for r in chunks} == {"debug_text"}  # dialogues are never chunked
    keys = spark.createDataFrame([(r.id,) for r in chunks], "id long").select("id", seeded_hash(42, "id").alias("h"))
    assert [r.id for r in chunks] == [r.id for r in keys.orderBy("h").collect()]
    stats = spark.read.json(layout.language_stats).collect()
    assert sum(r.records for r in stats) == total
    assert [r.chars for r in stats] == sorted((r.chars for r in stats), reverse=True)
    shards = spark.read.parquet(layout.chunk_shards)
    count = shards.select("shard").distinct().count()
    assert shards.count() == total and count > 3
    assert shards.select("_metadata.file_path").distinct().count() == count  # one file each


def test_limits_and_order_of_the_sample(spark, tmp_path):
    """With the document order kept, a limited source keeps its first rows."""
    layout, specs = Layout(str(tmp_path)), debug_sources()[:1]
    run_extract(spark, specs, "unused", layout)
    run_clean(spark, specs, layout)
    rules = spark.createDataFrame([("debug_text", False, 0.61)], schemas.RULE)
    options = AssemblyOptions(
        chunking=ChunkOptions(target_tokens=8, stride_tokens=8, min_tokens=1), shuffle_documents=False
    )
    run_assembly(spark, specs, layout, rules, options)
    texts = [r.text for r in spark.read.parquet(layout.chunk_shards).orderBy("id").collect()]
    kept = [t for t in R.CLEAN_TEXTS if t is not None]
    found = [any(k.startswith(t) for t in texts) for k in kept]
    assert found == [True, True, True, False, False]


def test_chat_output(spark, tmp_path):
    layout, specs = Layout(str(tmp_path)), debug_sources()
    run_extract(spark, specs, "unused", layout)
    run_clean(spark, specs, layout)
    run_assembly(spark, specs, layout)
    assert parquet_io.count_rows(spark, layout.dialogues) == 6  # bounds are off by default
    run_assembly(spark, specs, layout, options=AssemblyOptions(min_messages=3))
    bounded = spark.read.parquet(layout.dialogues)
    assert bounded.count() == bounded.where("n_messages >= 3").count() < 6


def test_document_order_can_be_kept(spark, tmp_path):
    layout, specs = Layout(str(tmp_path)), debug_sources()[:1]
    run_extract(spark, specs, "unused", layout)
    run_clean(spark, specs, layout)
    options = AssemblyOptions(
        chunking=ChunkOptions(target_tokens=8, stride_tokens=8, min_tokens=1), shuffle_documents=False
    )
    run_assembly(spark, specs, layout, options=options)
    texts = [r.text for r in spark.read.parquet(layout.chunk_shards).orderBy("id").collect()]
    kept = [t for t in R.CLEAN_TEXTS if t is not None]
    starts = [next(i for i, t in enumerate(texts) if k.startswith(t)) for k in kept]
    assert starts == sorted(starts)


def test_failed_source_is_recorded_and_retried(spark, tmp_path):
    layout = Layout(str(tmp_path))

    def broken(spark, _):
        raise ValueError("no such data")

    good = debug_sources()[0]
    specs = [SourceSpec("bad", 1, "text", broken), good]
    assert run_extract(spark, specs, "unused", layout) == {"debug_text": 8}
    results = {r.source: r.ok for r in load_manifest(spark, layout.manifest).collect()}
    assert results == {"bad": False, "debug_text": True}
    mended = [SourceSpec("bad", 1, "text", good.build), good]
    assert run_extract(spark, mended, "unused", layout) == {"bad": 8}


def test_failed_subset_is_skipped_named_and_retried(spark, tmp_path):
    root, layout = f"{tmp_path}/landed", Layout(f"{tmp_path}/corpus")
    articles = [(f"{lang} {long('text')} {i}", lang) for lang in ("en", "de", "fr", None) for i in range(3)]
    spark.createDataFrame(articles, "text string, lang string").write.partitionBy("lang").parquet(f"{root}/encyclopedia")
    folder = f"{root}/encyclopedia/lang=de"
    parts = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    whole = {f: open(f"{folder}/{f}", "rb").read() for f in parts}
    for f, data in whole.items():  # cut short: the footer is missing
        with open(f"{folder}/{f}", "wb") as out:
            out.write(data[: len(data) // 2])
        os.path.exists(f"{folder}/.{f}.crc") and os.remove(f"{folder}/.{f}.crc")
    specs = [s for s in builtin_sources() if s.name == "encyclopedia"]
    raw = lambda: extract.read_published(
        spark, extract.published_paths(spark, layout, "raw_extraction", layout.raw, "text"), schemas.TEXT, layout.raw("text")
    )
    assert run_extract(spark, specs, root, layout) == {"encyclopedia": 9}
    assert sorted({str(r.lang) for r in raw().collect()}) == ["None", "en", "fr"]
    entries = load_manifest(spark, layout.manifest).collect()
    assert {r.subset: r.ok for r in entries if r.subset} == {"en": True, "fr": True, "de": False, catalog.NO_VALUE: True}
    assert [(r.ok, r.failed_subsets) for r in entries if r.subset is None] == [(False, ["de"])]
    options = CleanOptions(("en", "de"))
    assert run_clean(spark, specs, layout, options) == {"encyclopedia": {"input": 9, "output": 3}}

    # only the failed one runs again, and cleaning sees that there is more
    for f, data in whole.items():
        with open(f"{folder}/{f}", "wb") as out:
            out.write(data)
    assert run_extract(spark, specs, root, layout) == {"encyclopedia": 12}
    again = load_manifest(spark, layout.manifest).collect()
    assert len(again) == len(entries) + 3 and sorted(r.subset for r in again if r.subset).count("de") == 2
    assert run_clean(spark, specs, layout, options) == {"encyclopedia": {"input": 12, "output": 6}}
    assert run_extract(spark, specs, root, layout) == {} == run_clean(spark, specs, layout, options)


def test_stopped_run_publishes_nothing(spark, tmp_path, monkeypatch):
    layout, specs = Layout(str(tmp_path)), debug_sources()[:1]
    run_extract(spark, specs, "unused", layout)
    rows = lambda: extract.read_published(
        spark, extract.published_paths(spark, layout, "raw_extraction", layout.raw, "text"), schemas.TEXT, layout.raw("text")
    )
    before = sorted(map(str, rows().collect()))

    class Stopped(BaseException):
        pass

    def stop(*_, **__):
        raise Stopped

    other = [SourceSpec("debug_text", 1, "text", lambda s, _: s.createDataFrame([(1, 0, "en", "other")], schemas.TEXT))]
    with monkeypatch.context() as patch:
        patch.setattr(extract, "record_result", stop)
        with pytest.raises(Stopped):
            run_extract(spark, other, "unused", layout, force=True)
    folder = f"{layout.raw('text', 'debug_text')}/subset={WHOLE}"
    assert len(os.listdir(folder)) == 2  # written, but not in the manifest
    assert sorted(map(str, rows().collect())) == before
    # results that newer ones replace are removed, but for the last of them
    for _ in range(3):
        assert run_extract(spark, other, "unused", layout, force=True) == {"debug_text": 1}
    assert [r.text for r in rows().collect()] == ["other"]
    assert len(os.listdir(folder)) == 3  # two results, and what the stopped run has left


def test_unreadable_files_are_named(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(100).repartition(4).write.parquet(path)
    spark.createDataFrame([], "id long").write.mode("append").parquet(path)
    assert parquet_io.file_counts(spark, [path]) == (100, [])
    part = sorted(f for f in os.listdir(path) if f.endswith(".parquet") and os.path.getsize(f"{path}/{f}") > 0)[0]
    rows = spark.read.parquet(f"{path}/{part}").count()
    with open(f"{path}/{part}", "r+b") as cut:
        cut.truncate(20)
    os.path.exists(f"{path}/.{part}.crc") and os.remove(f"{path}/.{part}.crc")
    left, bad = parquet_io.file_counts(spark, [path, f"{tmp_path}/missing"])
    assert left == 100 - rows and [b.rsplit("/", 1)[1] for b in bad] == [part]


def test_json_lines_are_like_parquet(spark, tmp_path):
    rows = [(i, f"text {i}\nwith \u2028 and \r é", f"{i % 3}") for i in range(500)]
    df = spark.createDataFrame(rows, "n long, text string, lang string").repartition(3)
    df.write.partitionBy("lang").parquet(f"{tmp_path}/p/data")
    # the same records in files of the same names
    for folder, _, files in os.walk(f"{tmp_path}/p/data"):
        for f in files:
            if f.endswith(".parquet") and not f.startswith("."):
                below = os.path.relpath(folder, f"{tmp_path}/p/data")
                os.makedirs(f"{tmp_path}/j/data/{below}", exist_ok=True)
                with open(f"{tmp_path}/j/data/{below}/{f.split('.')[0]}.jsonl", "w") as out:
                    for r in spark.read.parquet(f"{folder}/{f}").collect():
                        out.write(json.dumps({"n": r.n, "text": r.text, "more": [1]}) + "\n")
    schema = "n long, text string, lang string"
    expected = sorted(map(tuple, catalog.landed(spark, f"{tmp_path}/p/data", schema).collect()))
    for size in ("700", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = catalog.landed(spark, f"{tmp_path}/j/data", schema)
            assert found.columns == ["n", "text", "lang", "_file", "_row", "doc_id", "_block"]
            assert sorted(map(tuple, found.collect())) == expected
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with open(f"{tmp_path}/j/data/lang=0/torn.json", "w") as out:
        out.write('{"n": 1, "text": "a"}\n\n{"n": 2, "te\nnull\n{"n": "x"}\n  \n{"n": 7, "text": "z"}')
    with catalog.noticing() as noticed:
        found = catalog.landed(spark, f"{tmp_path}/j/data", schema).where("_file like '%torn'")
        assert sorted((r.n, r.text, r._row) for r in found.collect()) == [(1, "a", 0), (7, "z", 6)]
    assert noticed.bad_lines == 3
    spark.range(1).write.parquet(f"{tmp_path}/j/data/lang=1/more")
    with pytest.raises(ValueError):
        catalog.landed(spark, f"{tmp_path}/j/data", schema)


def test_bad_lines_are_in_the_manifest(spark, tmp_path):
    os.makedirs(f"{tmp_path}/landed/chemistry_shelves")
    with open(f"{tmp_path}/landed/chemistry_shelves/a.json", "w") as out:
        out.write(json.dumps({"text": long("atom")}) + "\n{broken\n" + json.dumps({"text": long("ion")}) + "\n")
    layout = Layout(f"{tmp_path}/corpus")
    scratch = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(scratch))
    specs = [s for s in builtin_sources() if s.name == "chemistry_shelves"]
    assert run_extract(spark, specs, f"{tmp_path}/landed", layout) == {"chemistry_shelves": 2}
    (entry,) = load_manifest(spark, layout.manifest).collect()
    assert (entry.ok, entry.num_records, entry.bad_lines, entry.languages) == (True, 2, 1, ["en"])
    assert not [f for f in set(os.listdir(scratch)) - before if f.startswith("landed-lines")]


def test_source_without_rows_is_done(spark, tmp_path):
    layout = Layout(str(tmp_path))
    specs = [SourceSpec("none", 1, "text", lambda s, _: s.createDataFrame([], schemas.TEXT))]
    assert run_extract(spark, specs, "unused", layout) == {"none": 0}
    assert run_clean(spark, specs, layout) == {"none": {"input": 0, "output": 0}}
    assert run_extract(spark, specs, "unused", layout) == {} == run_clean(spark, specs, layout)


def test_parquet_sink_and_scans(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert parquet_io.write_table(spark.range(10), path) == 10
    assert any(name.endswith(".zstd.parquet") for name in os.listdir(path))
    assert parquet_io.count_rows(spark, path) == parquet_io.read_table(spark, path).count() == 10
    with open(f"{path}/junk.parquet", "wb") as junk:
        junk.write(b"not a table")
    assert parquet_io.count_rows(spark, path) == 10
    missing = f"{tmp_path}/missing"
    assert parquet_io.count_rows(spark, missing) == 0
    assert parquet_io.read_or_empty(spark, missing, schemas.TEXT).collect() == []
    assert not parquet_io.path_exists(spark, missing) and parquet_io.path_exists(spark, path)
    with pytest.raises(AnalysisException):
        parquet_io.read_table(spark, missing)


def test_json_report(spark, tmp_path):
    parquet_io.write_json(spark.range(3).coalesce(2), f"{tmp_path}/r")
    files = [f for f in os.listdir(f"{tmp_path}/r") if f.endswith(".json")]
    assert len(files) == 1
    with open(f"{tmp_path}/r/{files[0]}") as lines:
        assert sorted(json.loads(line)["id"] for line in lines) == [0, 1, 2]


def test_source_selection(spark):
    sources = spark.createDataFrame([("a", 1, "text"), ("b", 2, "text"), ("c", 3, "text")], schemas.SOURCE)
    settings = spark.createDataFrame([("a", None), ("b", False), ("zzz", True)], "source string, enabled boolean")
    names = lambda df: sorted(r.source for r in df.collect())
    assert names(select_sources(sources)) == ["a", "b", "c"]
    assert names(select_sources(sources, settings=settings)) == ["a"]
    assert names(select_sources(sources, only="b", settings=settings)) == ["b"]
    assert names(select_sources(sources, only="nope")) == []


def test_stream_cleans_new_files_only(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("part", F.lit(0))
    docs = schemas.project(docs, schemas.TEXT)
    inbox, target, state = (f"{tmp_path}/{n}" for n in ("inbox", "target", "state"))
    options = CleanOptions(("en", "de"))
    halves = docs.randomSplit([0.5, 0.5], seed=1)
    for half in halves:
        half.coalesce(1).write.mode("append").parquet(inbox)
        clean_stream(spark, inbox, schemas.TEXT, target, state, options).awaitTermination()
    got = spark.read.parquet(target)
    expected = clean_records(docs, options)
    assert sorted(map(tuple, got.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))
