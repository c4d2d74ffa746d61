"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom import schemas
from textloom.functions import cleaning as C
from textloom.functions import validation as V
from textloom.operators import chunking, export, langid, mixing, ordering, records, shaping
from textloom.options import ChunkOptions, CleanOptions
from textloom.plans.extract import published_paths, read_published, run_extract
from textloom.plans.layout import Layout
from textloom.session import scratch_path, spread
from textloom.sources import manifest as M
from textloom.sources.catalog import DEFAULT_STOP_MARKERS, NO_VALUE, STOP_MARKERS, SourceSpec, by_script, landed, noticing
from textloom.sources.parquet_io import read_or_empty, read_table, write_json, write_table
from textloom.streaming.clean_stream import clean_stream
from workload import views
from workload.views import SEED

Query = Callable[[SparkSession, str], DataFrame]
CLEAN = CleanOptions(allowed_langs=("en", "de"))
CHUNKS = ChunkOptions()
SHARD_BYTES = 100_000
DOC_ORDER = ["_hash", "doc_id", "part"]
DOC_BUCKETS = ["source", "_bucket"]


# ------------------------------------------------------------------ shaping
def src_min_length(spark: SparkSession, d: str) -> DataFrame:
    return shaping.unpivot_texts(views.documents(spark, d), {"text": F.col("lang")})


def src_unpivot(spark: SparkSession, d: str) -> DataFrame:
    lines = F.split("text", "\n", -1)
    wide = views.documents(spark, d).select(
        "doc_id",
        "lang",
        F.col("text").alias("full text"),
        F.element_at(lines, 1).alias("summary"),
        F.element_at(lines, -1).alias("ending"),
        F.array_join(F.slice(lines, 1, 3), " ").alias("opening"),
    )
    return shaping.unpivot_texts(
        wide, {"full text": F.col("lang"), "summary": "en", "ending": "ru", "opening": "tok"}
    )


def src_nested_explode(spark: SparkSession, d: str) -> DataFrame:
    parts = views.doc_parts(spark, d)
    return shaping.nested_texts(parts, "description", "parts", "clean_text", F.col("lang"))


def src_run_concat(spark: SparkSession, d: str) -> DataFrame:
    lines = views.doc_lines(spark, d)
    runs = shaping.concat_runs(lines, "book", "line", ["_bucket"], ["doc_id", "line_no"])
    return runs.select("start.doc_id", "start.line_no", "book", "text")


def src_run_concat_lines(spark: SparkSession, d: str) -> DataFrame:
    """The same runs, one row per line."""
    lines = views.doc_lines(spark, d)
    runs = shaping.run_lines(lines, "book", "line", ["_bucket"], ["doc_id", "line_no"])
    return runs.select("start.doc_id", "start.line_no", "book", "position", "line")


def _turns_by_role(spark: SparkSession, d: str) -> DataFrame:
    turns = views.dirty_turns(spark, d).withColumn("_block", F.floor(F.col("turn") / 64))
    return turns.withColumn("lang", F.when(F.col("role") == "user", "en").otherwise("de"))


def src_group_concat(spark: SparkSession, d: str) -> DataFrame:
    joined = shaping.concat_groups(_turns_by_role(spark, d), "conv_id", "text", "lang", ["_block"], ["turn"])
    return joined.select("conv_id", "start.turn", "lang", "text")


def src_group_concat_lines(spark: SparkSession, d: str) -> DataFrame:
    """The same groups, one row per line."""
    lines = shaping.group_lines(_turns_by_role(spark, d), "conv_id", "text", "lang", ["_block"], ["turn"])
    return lines.select("conv_id", "start.turn", "lang", "position", F.col("text").alias("line"))


def src_hash_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = views.documents(spark, d).select(
        "doc_id",
        F.concat(F.lit("Answer: "), "text").alias("completion"),
        F.col("text").alias("prompt"),
    )
    return shaping.answers_and_unique_prompts(docs, "completion", "prompt", "en", ["doc_id"])


def src_lang_cap(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(ordering.range_bucket(views.documents(spark, d), "doc_id", "_bucket"), "doc_id")
    texts = shaping.unpivot_texts(docs, {"text": F.col("lang")}, keep=("_bucket",))
    return shaping.cap_per_language(texts, views.CAPS, ["_bucket"], ["doc_id"]).drop("_bucket")


def src_union(spark: SparkSession, d: str) -> DataFrame:
    """Subsets by language, shaped one by one and put together."""
    docs = views.documents(spark, d)
    listed = [F.col("lang") == lang for lang in views.CAPS]
    rest = F.col("lang").isNull() | ~F.col("lang").isin(*views.CAPS)
    shaped = [shaping.unpivot_texts(docs.where(subset), {"text": F.col("lang")}) for subset in [*listed, rest]]
    return shaping.union_subsets(shaped)


def src_union_partial(spark: SparkSession, d: str) -> DataFrame:
    """Documents landed by language, the first language as files nobody can read: what each language came to."""
    root = scratch_path(spark, "landed")
    docs = views.documents(spark, d).select("text", F.coalesce("lang", F.lit(NO_VALUE)).alias("lang"))
    broken = docs.agg(F.min("lang")).first()[0]
    docs.where(F.col("lang") != broken).write.partitionBy("lang").parquet(f"{root}/articles")
    docs.where(F.col("lang") == broken).select("text").write.text(f"{root}/articles/lang={broken}")

    def build(spark: SparkSession, path: str, lang: str) -> DataFrame:
        rows = landed(spark, path, "text string, lang string")
        mine = F.col("lang").isNull() if lang == NO_VALUE else F.col("lang") == lang
        return shaping.unpivot_texts(rows.where(mine), {"text": F.col("lang")})

    layout = Layout(scratch_path(spark, "partial"))
    run_extract(spark, [SourceSpec("articles", 3, "text", build, subset_column="lang")], root, layout)
    manifest = M.load_manifest(spark, layout.manifest)
    whole = manifest.where("subset is null").select(F.explode("failed_subsets").alias("subset"), F.lit(1).alias("named"))
    raw = read_published(
        spark, published_paths(spark, layout, M.EXTRACT, layout.raw, "text"), schemas.TEXT, layout.raw("text")
    )
    texts = raw.groupBy(F.coalesce("lang", F.lit(NO_VALUE)).alias("subset")).agg(F.count("*").alias("records"), F.sum(F.length("text")).alias("chars"))
    states = M.latest_subsets(manifest, M.EXTRACT).select("subset", F.col("ok").cast("int").alias("ok"))
    joined = states.join(texts, "subset", "left").join(whole, "subset", "left")
    zero = F.lit(0)
    return joined.select("subset", "ok", F.coalesce("named", zero).alias("named"), F.coalesce("records", zero).alias("records"), F.coalesce("chars", zero).alias("chars"))


def landed_json(spark: SparkSession, d: str) -> DataFrame:
    """Documents landed as lines of JSON, with broken lines among them: records with the number of their line."""
    root = scratch_path(spark, "landed-json")
    docs = views.documents(spark, d).where("lang is not null")
    line = F.to_json(F.struct(F.col("doc_id").alias("number"), "source", "text"))
    lines = docs.select("lang", F.floor(F.col("doc_id") / 2000).alias("part"), "doc_id", F.lit(0).alias("kind"), line.alias("value"))
    # a line cut short, and an empty one
    torn = lines.where("doc_id % 7 = 3").withColumn("kind", F.lit(1)).withColumn("value", F.expr("left(value, length(value) - 3)"))
    empty = lines.where("doc_id % 5 = 2").withColumn("kind", F.lit(2)).withColumn("value", F.lit(""))
    every = lines.union(torn).union(empty).repartition("lang", "part").sortWithinPartitions("lang", "part", "doc_id", "kind")
    every.select("lang", "part", "value").write.partitionBy("lang", "part").text(f"{root}/lines")
    with noticing() as noticed:
        schema = "number long, source string, text string, lang string, part long"
        rows = landed(spark, f"{root}/lines", schema, json_files="*.txt")
    found = rows.select("lang", "part", F.col("_row").alias("line"), "number", "source", "text")
    return found.withColumn("bad_lines", F.lit(noticed.bad_lines).cast("long"))


def src_stop_marker(spark: SparkSession, d: str) -> DataFrame:
    marked = views.marked_documents(spark, d)
    return shaping.cut_at_marker(marked, STOP_MARKERS, DEFAULT_STOP_MARKERS)


def src_schema_project(spark: SparkSession, d: str) -> DataFrame:
    raw = views.raw_dialogues(views.dirty_turns(spark, d))
    return _messages(schemas.project(raw, schemas.DIALOGUE))


def src_select(spark: SparkSession, d: str) -> DataFrame:
    sources = views.sources(spark, d)
    settings = sources.select(
        "source", F.when(F.col("tier") > 1, F.col("tier") == 2).alias("enabled")
    )
    return M.select_sources(sources, settings=settings)


# ----------------------------------------------------------------- cleaning
def _step(step: Callable[[Column], Column]) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        docs = views.dirty_documents(spark, d)
        return docs.select("doc_id", step(F.col("text")).alias("text"))

    return query


def _flag(name: str, test: Callable[[Column], Column]) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        docs = views.dirty_documents(spark, d)
        return docs.select("doc_id", test(F.col("text")).cast("int").alias(name))

    return query


def clean_records(spark: SparkSession, d: str) -> DataFrame:
    return records.clean_records(views.dirty_documents(spark, d), CLEAN)


def _messages(dialogues: DataFrame) -> DataFrame:
    return dialogues.select(
        "doc_id", "lang", F.posexplode("messages").alias("position", "message")
    ).select("doc_id", "lang", "position", "message.role", "message.content")


def clean_dialogues(spark: SparkSession, d: str) -> DataFrame:
    raw = schemas.project(views.raw_dialogues(views.dirty_turns(spark, d)), schemas.DIALOGUE)
    return _messages(records.clean_dialogues(raw, CLEAN))


def clean_turns(spark: SparkSession, d: str) -> DataFrame:
    turns = views.dirty_turns(spark, d).withColumn("lang", F.lit("en"))
    return records.clean_turns(turns, "conv_id", "text", CLEAN)


def _listed(languages: str) -> Column:
    return F.array_join(languages, ",").alias("languages")


def clean_funnel(spark: SparkSession, d: str) -> DataFrame:
    raw = views.dirty_documents(spark, d)
    funnel = records.clean_funnel(raw, records.clean_records(raw, CLEAN))
    return funnel.select("source", "rows_in", "rows_out", _listed("languages"))


def stream_clean(spark: SparkSession, d: str) -> DataFrame:
    target, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    schema = spark.read.parquet(f"{d}/documents.parquet").schema
    slots = spark.sparkContext.defaultParallelism
    clean_stream(
        spark, f"{d}/documents*.parquet", schema, target, checkpoint, CLEAN, slots=slots
    ).awaitTermination()
    return read_or_empty(spark, target, schema).select("doc_id", "lang", "source", "text")


# ------------------------------------------------------------------- mixing
def _text_documents(spark: SparkSession, d: str) -> DataFrame:
    return views.documents(spark, d).withColumn("part", F.lit(0))


def _plan(spark: SparkSession, d: str, docs: DataFrame) -> DataFrame:
    counts = docs.groupBy("source").agg(F.count("*").alias("num_records"))
    rules = spark.createDataFrame(views.RULES, schemas.RULE)
    return mixing.mix_plan(views.sources(spark, d), counts, rules, base_tier=1)


def mix_plan(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d, _text_documents(spark, d))


def mix_plan_lowest_tier(spark: SparkSession, d: str) -> DataFrame:
    docs = _text_documents(spark, d)
    counts = docs.groupBy("source").agg(F.count("*").alias("num_records"))
    rules = spark.createDataFrame(views.RULES, schemas.RULE)
    higher = views.sources(spark, d).where(F.col("tier") > 1)
    return mixing.mix_plan(higher, counts, rules, base_tier=1)


def _sampled(spark: SparkSession, d: str) -> DataFrame:
    docs = _text_documents(spark, d)
    return mixing.mix_sample(docs, _plan(spark, d, docs), SEED)


def mix_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sampled(spark, d).select("source", "doc_id", "lang", "text")


def mix_sample_in_order(spark: SparkSession, d: str) -> DataFrame:
    """The first documents of each source instead of a seeded choice."""
    docs = _text_documents(spark, d)
    placed = ordering.range_bucket(docs, "doc_id", "_bucket")
    return mixing.mix_ordered(placed, _plan(spark, d, docs), ["doc_id", "part"]).select("source", "doc_id", "lang", "text")


def tier_override(spark: SparkSession, d: str) -> DataFrame:
    docs = _text_documents(spark, d)
    counts = docs.groupBy("source").agg(F.count("*").alias("num_records"))
    sources = mixing.with_tier_overrides(views.sources(spark, d), views.TIER_OVERRIDES)
    return mixing.mix_plan(sources, counts, spark.createDataFrame(views.RULES, schemas.RULE), base_tier=2)


# ----------------------------------------------------------------- chunking
def chunk_budgets(spark: SparkSession, d: str) -> DataFrame:
    langs = views.documents(spark, d).groupBy("lang").agg(F.count("*").alias("documents"))
    return langs.select("lang", "documents", F.inline(F.array(chunking.chunk_budgets(F.col("lang"), CHUNKS))))


def chunk_text(spark: SparkSession, d: str) -> DataFrame:
    docs = views.spread_documents(spark, d).select("doc_id", "lang", "text")
    return chunking.chunk_rows(docs, CHUNKS)


def chunk_text_short_windows(spark: SparkSession, d: str) -> DataFrame:
    """Many small windows: the chunk cap and the document cut are reached."""
    options = ChunkOptions(target_tokens=32, stride_tokens=28, min_tokens=8, max_chunks=20, max_document_chars=3000)
    docs = views.spread_documents(spark, d).select("doc_id", "lang", "text")
    return chunking.chunk_rows(docs, options)


def chunk_multi_size(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of three sizes from one pass over the texts."""
    sizes = [ChunkOptions(target_tokens=t, stride_tokens=t * 7 // 8, min_tokens=t // 4) for t in views.CHUNK_SIZES]
    return chunking.chunk_rows_sizes(views.spread_documents(spark, d).select("doc_id", "lang", "text"), sizes)


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    docs = mixing.with_shuffle_order(_text_documents(spark, d), SEED)
    return chunking.number_chunks(docs, DOC_BUCKETS, DOC_ORDER, CHUNKS)


def chunk_ids(spark: SparkSession, d: str) -> DataFrame:
    return _numbered(spark, d).select(*schemas.CHUNK.names)


def dense_index(spark: SparkSession, d: str) -> DataFrame:
    lines = views.doc_lines(spark, d)
    return ordering.dense_index(lines, ["_bucket"], ["doc_id", "line_no"], "row_index").drop("_bucket")


# ------------------------------------------------------- statistics, export
def lang_stats(spark: SparkSession, d: str) -> DataFrame:
    return export.language_stats(chunk_text(spark, d))


def corpus_stats(spark: SparkSession, d: str) -> DataFrame:
    """Documents to cleaned records to chunks to characters per language."""
    return export.language_stats(chunking.chunk_rows(clean_records(spark, d), CHUNKS))


def shard_assign(spark: SparkSession, d: str) -> DataFrame:
    numbered = _numbered(spark, d)
    return numbered.select("id", "byte_start", export.shard_number(F.col("byte_start"), SHARD_BYTES).alias("shard"))


def compression_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Text bytes and rows of the written chunks, and whether the files are smaller than the text."""
    path = scratch_path(spark, "ratio")
    write_table(chunking.chunk_rows(_text_documents(spark, d), CHUNKS), path)
    smaller = ((F.col("parquet_bytes") > 0) & (F.col("ratio") > 1)).cast("int").alias("smaller")
    return export.compression_ratio(spark, path).select("raw_bytes", "rows", smaller)


def chat_export(spark: SparkSession, d: str) -> DataFrame:
    """The shuffled, written dialogues: cleaned, of two messages or more and of at most 600 estimated tokens."""
    raw = schemas.project(views.raw_dialogues(views.dirty_turns(spark, d)), schemas.DIALOGUE)
    chosen = export.chat_dialogues(records.clean_dialogues(raw, CLEAN), min_messages=2, max_tokens=600)
    path = scratch_path(spark, "chat")
    write_table(export.global_shuffle(chosen, SEED, ["doc_id"]), path)
    return _with_position(spark, path).select("position", "doc_id", "lang", "n_messages", "est_tokens")


def _with_position(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a written table with their place in it: files by name, rows in file order."""
    rows = read_table(spark, path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    return ordering.dense_index(rows, ["_file"], ["_row"], "position").drop("_file", "_row")


def global_shuffle(spark: SparkSession, d: str) -> DataFrame:
    """The written, shuffled table: what it holds and in which order."""
    path = scratch_path(spark, "dataset")
    write_table(export.global_shuffle(chunk_ids(spark, d), SEED, ["id"]), path)
    return _with_position(spark, path)


def sink_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    layout = Layout(scratch_path(spark, "roundtrip"))
    rows = write_table(chunk_ids(spark, d), layout.chunk_shards)
    written = read_table(spark, layout.chunk_shards)
    write_json(export.language_stats(written), layout.language_stats, *export.stats_order())
    stats = spark.read.schema("lang string, records long, chars long").json(layout.language_stats)
    return stats.withColumn("rows_written", F.lit(rows))


# ----------------------------------------------------------------- manifest
def stage_metrics(spark: SparkSession, d: str) -> DataFrame:
    metrics = M.stage_metrics(views.documents(spark, d))
    return metrics.select("source", "num_records", _listed("languages"))


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    """Two runs of the clean stage: every third source failed first, every fourth failed last."""
    metrics = M.stage_metrics(views.documents(spark, d))
    number = views.source_number(F.col("source"))
    runs = metrics.withColumn("run", F.explode(F.sequence(F.lit(1), F.lit(2))))
    return runs.select(
        "source",
        F.lit(M.CLEAN).alias("stage"),
        F.when(F.col("run") == 1, number % 3 != 0).otherwise(number % 4 != 0).alias("ok"),
        "num_records",
        F.lit(1.0).alias("duration_sec"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("run")).alias("finished_at"),
        "languages",
    )


def stage_pending(spark: SparkSession, d: str) -> DataFrame:
    sources = views.sources(spark, d)
    existing = sources.where(views.source_number(F.col("source")) % 5 != 0)
    return M.pending_sources(sources, _manifest(spark, d), existing, M.CLEAN)


def stage_latest(spark: SparkSession, d: str) -> DataFrame:
    latest = M.latest_results(_manifest(spark, d))
    return latest.select("source", "stage", F.col("ok").cast("int").alias("ok"), "num_records", _listed("languages"))


# ----------------------------------------------------------------- language
def lang_detect(spark: SparkSession, d: str) -> DataFrame:
    """All documents, in two halves: each is labelled by a model of the other one."""
    docs = views.spread_documents(spark, d).select("doc_id", "lang", "text")
    odd = F.col("doc_id") % 2 == 1
    halves = [
        langid.detect(docs.where(half).select("doc_id", "text"), langid.train(docs.where(~half)))
        for half in (odd, ~odd)
    ]
    return halves[0].union(halves[1]).select("doc_id", "detected")


def detect_stored_model(spark: SparkSession, d: str) -> DataFrame:
    """All documents, labelled as a source of unlabelled texts would be: by a model that was trained and stored before."""
    docs = views.spread_documents(spark, d).select("doc_id", "lang", "text")
    path = scratch_path(spark, "language-model")
    langid.save(langid.train(docs), path)
    return langid.stored_detector(path)(docs.select("doc_id", "text"), ["doc_id"]).select("doc_id", "detected")


def detect_by_script(spark: SparkSession, d: str) -> DataFrame:
    return by_script(views.documents(spark, d), ["doc_id"]).select("doc_id", "detected")


QUERIES: dict[str, Query] = {
    "src_min_length": src_min_length,
    "src_unpivot": src_unpivot,
    "src_nested_explode": src_nested_explode,
    "src_run_concat": src_run_concat,
    "src_group_concat": src_group_concat,
    "src_run_concat_lines": src_run_concat_lines,
    "src_group_concat_lines": src_group_concat_lines,
    "src_hash_dedup": src_hash_dedup,
    "src_lang_cap": src_lang_cap,
    "src_union": src_union,
    "src_union_partial": src_union_partial,
    "landed_json": landed_json,
    "src_stop_marker": src_stop_marker,
    "src_schema_project": src_schema_project,
    "src_select": src_select,
    "clean_special_tokens": _step(C.drop_special_tokens),
    "clean_urls": _step(C.drop_urls),
    "clean_control": _step(C.drop_control),
    "clean_technical": _step(C.drop_technical),
    "clean_repeats": _step(C.squeeze_repeats),
    "clean_empty_pairs": _step(C.drop_empty_pairs),
    "clean_lonely": _step(C.drop_lonely_marks),
    "clean_punct": _step(C.fix_punctuation),
    "clean_whitespace": _step(C.fix_whitespace),
    "nfkc": _step(C.nfkc),
    "clean_text_full": _step(C.clean_text),
    "valid_garbage": _flag("is_garbage", V.is_garbage),
    "valid_text": _flag("is_valid", V.is_valid),
    "valid_code": _flag("code_hits", V.code_hits),
    "clean_records": clean_records,
    "clean_dialogues": clean_dialogues,
    "clean_turns": clean_turns,
    "clean_funnel": clean_funnel,
    "stream_clean": stream_clean,
    "mix_plan": mix_plan,
    "mix_plan_lowest_tier": mix_plan_lowest_tier,
    "mix_sample": mix_sample,
    "mix_sample_in_order": mix_sample_in_order,
    "tier_override": tier_override,
    "chunk_budgets": chunk_budgets,
    "chunk_text": chunk_text,
    "chunk_text_short_windows": chunk_text_short_windows,
    "chunk_multi_size": chunk_multi_size,
    "chunk_ids": chunk_ids,
    "dense_index": dense_index,
    "lang_stats": lang_stats,
    "corpus_stats": corpus_stats,
    "shard_assign": shard_assign,
    "compression_ratio": compression_ratio,
    "chat_export": chat_export,
    "global_shuffle": global_shuffle,
    "sink_roundtrip": sink_roundtrip,
    "stage_metrics": stage_metrics,
    "stage_pending": stage_pending,
    "stage_latest": stage_latest,
    "lang_detect": lang_detect,
    "detect_stored_model": detect_stored_model,
    "detect_by_script": detect_by_script,
}
