"""Source contract and the built-in sources, read from files that were landed beforehand.

A source is a name, a quality tier, a content type and a function from a landed
folder to records; adding one means adding a ``SourceSpec``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom import schemas
from textloom.functions.cleaning import py_strip
from textloom.functions.patterns import CYRILLIC
from textloom.operators import shaping
from textloom.operators.ordering import join_small, running_totals
from textloom.options import MIN_SOURCE_CHARS
from textloom.session import scratch_path, settle
from textloom.sources.parquet_io import list_files, write_table

# ---------------------------------------------------------------- fixed values
ENCYCLOPEDIA_CAPS = {
    "en": 500_000, "ru": 500_000,
    "de": 50_000, "fr": 50_000, "es": 50_000, "it": 50_000, "pt": 50_000,
    "pl": 50_000, "uk": 50_000, "ja": 50_000, "zh": 50_000, "ar": 50_000,
}
DEFAULT_STOP_MARKERS = (
    "См. также", "See also", "Siehe auch", "Voir aussi", "Ver también", "Vedi anche",
    "Veja também", "Zobacz też", "Див. також", "関連項目", "参见", "انظر أيضًا",
)
STOP_MARKERS = {
    "ru": ("См. также", "Примечания", "Ссылки", "Литература"),
    "en": ("See also", "References", "External links", "Notes", "Further reading"),
    "de": ("Siehe auch", "Literatur", "Weblinks", "Einzelnachweise"),
    "fr": ("Voir aussi", "Notes et références", "Liens externes", "Bibliographie"),
    "es": ("Véase también", "Referencias", "Enlaces externos", "Bibliografía"),
    "it": ("Voci correlate", "Note", "Altri progetti", "Collegamenti esterni"),
    "pt": ("Ver também", "Referências", "Ligações externas", "Bibliografia"),
    "pl": ("Zobacz też", "Przypisy", "Linki zewnętrzne", "Bibliografia"),
    "uk": ("Див. також", "Примітки", "Посилання", "Література"),
    "ja": ("関連項目", "脚注", "外部リンク", "参考文献"),
    "zh": ("参见", "参考资料", "外部链接", "参考文献"),
    "ar": ("انظر أيضًا", "مراجع", "وصلات خارجية", "ملاحظات"),
}
# ------------------------------------------------------------ end fixed values

ROWS_PER_BLOCK = 1 << 20
JSON_FILES = "*.{json,jsonl,ndjson,json.gz,jsonl.gz,ndjson.gz,json.bz2,jsonl.bz2,json.zst,jsonl.zst}"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

# (texts, key columns) -> texts with a column "detected"; see operators.langid.detect
Detector = Callable[[DataFrame, list[str]], DataFrame]


@dataclass(frozen=True)
class SourceSpec:
    name: str
    tier: int
    content_type: str  # "text" or "dialogue"
    build: Callable[..., DataFrame]  # (spark, landed folder), and the subset if the source is divided
    subset_column: str | None = None  # partition column of the landed files; its values are extracted one by one


@dataclass
class Noticed:
    """What a scan came across that no record shows, and the tables it wrote for its own use."""

    bad_lines: int = 0
    scratch: list[str] = field(default_factory=list)


_noticed: ContextVar[Noticed | None] = ContextVar("noticed", default=None)


@contextmanager
def noticing() -> Iterator[Noticed]:
    """Collects what the scans of this thread notice."""
    token = _noticed.set(Noticed())
    try:
        yield _noticed.get()
    finally:
        _noticed.reset(token)


def sources_table(spark: SparkSession, specs: Iterable[SourceSpec]) -> DataFrame:
    rows = [(s.name, s.tier, s.content_type) for s in specs]
    return spark.createDataFrame(rows, schemas.SOURCE)


def landed(spark: SparkSession, path: str, schema: str | T.StructType, json_files: str = JSON_FILES) -> DataFrame:
    """Scan landed files: Parquet, or lines of JSON (``.json``, ``.jsonl``, ``.ndjson``, compressed or not, or as ``json_files`` says).

    ``_file`` (below ``path``, without extension) and ``_row`` give each row's fixed place, whatever the split of the
    scan; ``_block`` groups neighbouring rows.  ``doc_id`` is a 64-bit hash of the place, so samples and shuffles
    that go by it are the same for any split, cluster, landed root and file format.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if list_files(spark, path, json_files).limit(1).count():
        if list_files(spark, path, "*.parquet").limit(1).count():
            raise ValueError(f"{path}: Parquet files and lines of JSON, but a landed folder has one format")
        rows = _json_lines(spark, path, schema, json_files)
    else:
        rows = spark.read.schema(schema).parquet(path)
        rows = rows.select("*", _file_below(path).alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return rows.select("*", place_key(F.col("_file"), F.col("_row")).alias("doc_id"), F.floor(F.col("_row") / ROWS_PER_BLOCK).alias("_block"))


def _file_below(path: str) -> Column:
    name = path.rstrip("/").rpartition("/")[2]
    below = F.substring_index(F.col("_metadata.file_path"), f"/{name}/", -1)
    return F.regexp_replace(below, r"\.[^/]*$", "")


def _json_lines(spark: SparkSession, path: str, schema: T.StructType, json_files: str) -> DataFrame:
    """The records of JSON lines, with the number of their line in its file as ``_row``.

    A split knows the order of its lines, but not how many come before it.  So the lines are parsed and written once, with their
    split and their place in it; the written table tells how many lines each split has, and sums over them give the numbers.
    A line that is no object of the schema is left out, and counted for ``noticing``; an empty line only takes a number.
    """
    lines = spark.read.option("pathGlobFilter", json_files).option("lineSep", "\n").text(path)
    partitions = [c for c in lines.columns if c != "value"]
    own = T.StructType([f for f in schema if f.name not in partitions])
    parsed = F.from_json("value", T.StructType([*own, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad"})
    placed = lines.select(
        _file_below(path).alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_at"),
        (F.trim("value") == "").alias("_empty"),
        parsed.alias("_record"),
        *[F.col(f.name).cast(f.dataType) for f in schema if f.name in partitions],
    )
    staged = scratch_path(spark, "landed-lines")
    write_table(placed, staged)
    written = spark.read.schema(placed.schema).parquet(staged)
    splits, many = settle(written.groupBy("_file", "_split").agg(F.count("*").alias("_lines"), F.min("_at").alias("_first")))
    # lines before a split, in its file
    before = running_totals(splits, ["_file", "_split"], ["_lines"], many).join(splits, ["_file", "_split"])
    start = before.groupBy("_file").agg(F.min("_offset__lines").alias("_file_start"))
    offsets = before.join(start, "_file").select("_file", "_split", "_first", (F.col("_offset__lines") - F.col("_file_start")).alias("_before"))
    bad = ~F.col("_empty") & (F.col("_record").isNull() | F.col("_record._bad").isNotNull())
    noticed = _noticed.get()
    if noticed is not None:
        noticed.scratch.append(staged)
        noticed.bad_lines += written.where(bad).count()
    good = join_small(written.where(~F.col("_empty") & ~bad), offsets, ["_file", "_split"])
    row = F.col("_before") + F.col("_at") - F.col("_first")
    return good.select(*[F.col(f.name if f.name in partitions else f"_record.{f.name}") for f in schema], "_file", row.alias("_row"))


def landed_subsets(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a partition column of landed files, from the listing of the files alone."""
    value = F.regexp_extract("path", f"/{column}=([^/]*)/", 1)
    found = list_files(spark, path).select(value.alias("value")).where("value <> ''").distinct().collect()  # one row per folder
    return sorted(unquote(r["value"]) for r in found)


def place_key(file: Column, row: Column) -> Column:
    return F.xxhash64(file, row)


def by_script(texts: DataFrame, keys: list[str]) -> DataFrame:
    """The default detector: the language of the prevailing script, ``ru`` or ``en``; no letters of either: ``unknown``.

    For finer labels pass a trained model (``operators.langid``).
    """
    cyrillic = F.length(F.regexp_replace("text", rf"[^{CYRILLIC}]", ""))
    latin = F.length(F.regexp_replace("text", "[^A-Za-z]", ""))
    detected = F.when((cyrillic > 0) & (cyrillic >= latin), "ru").when(latin > 0, "en").otherwise("unknown")
    return texts.withColumn("detected", detected)


BLOCK = ["_file", "_block"]
PLACE = ["_file", "_row"]


def columns_source(name: str, tier: int, columns: dict[str, str]) -> SourceSpec:
    """A source with one record per listed text column."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])

    def build(spark: SparkSession, path: str) -> DataFrame:
        return shaping.unpivot_texts(landed(spark, path, schema), columns)

    return SourceSpec(name, tier, "text", build)


def _fan_fiction(spark: SparkSession, path: str) -> DataFrame:
    schema = "description string, parts array<struct<clean_text: string>>"
    return shaping.nested_texts(landed(spark, path, schema), "description", "parts", "clean_text", "ru")


def _poetry(spark: SparkSession, path: str) -> DataFrame:
    lines = landed(spark, path, "gutenberg_id long, line string")
    runs = shaping.concat_runs(lines, "gutenberg_id", "line", BLOCK, PLACE)
    return _with_key(runs.withColumn("lang", F.lit("en")))


def _stories(spark: SparkSession, path: str) -> DataFrame:
    rows = landed(spark, path, "completion string, prompt_problem_solving_story string")
    return shaping.answers_and_unique_prompts(
        rows, "completion", "prompt_problem_solving_story", "en", PLACE
    )


def _subtitles(spark: SparkSession, path: str) -> DataFrame:
    lines = landed(spark, path, "file_id string, text string, language string")
    return _with_key(shaping.concat_groups(lines, "file_id", "text", "language", BLOCK, PLACE))


def _wiki_reading(detector: Detector):
    def build(spark: SparkSession, path: str) -> DataFrame:
        rows = landed(spark, path, "text string").withColumn("text", py_strip(F.col("text")))
        rows = rows.where(F.length("text") >= MIN_SOURCE_CHARS)
        return shaping.unpivot_texts(detector(rows, PLACE), {"text": F.col("detected")})

    return build


def _encyclopedia(caps: Mapping[str, int]):
    def build(spark: SparkSession, path: str, lang: str | None = None) -> DataFrame:
        """Articles landed below ``lang=<code>`` folders, of one language if given; missing languages are simply not there."""
        rows = landed(spark, path, "text string, lang string").withColumn("part", F.lit(0))
        if lang is not None:  # prunes the other folders: what is broken there does no harm
            rows = rows.where(F.col("lang").isNull() if lang == NO_VALUE else F.col("lang") == lang)
        cut = shaping.cut_at_marker(rows, STOP_MARKERS, DEFAULT_STOP_MARKERS)
        return shaping.cap_per_language(cut, caps, BLOCK, PLACE).select(*shaping.RECORD)

    return build


def _with_key(texts: DataFrame) -> DataFrame:
    """The key of a joined text is the place of its first line."""
    keyed = texts.withColumn("doc_id", place_key(F.col("start._file"), F.col("start._row"))).withColumn("part", F.lit(0))
    return keyed.select(*shaping.RECORD)


def builtin_sources(
    detector: Detector = by_script, encyclopedia_caps: Mapping[str, int] | None = None
) -> list[SourceSpec]:
    """All built-in sources; ``detector`` labels the texts of those without languages.

    ``encyclopedia_caps`` (``ENCYCLOPEDIA_CAPS`` holds usual ones) limits articles per language; there is no limit by default.
    """
    return [
        columns_source("book_summaries", 1, {"Full Text": "ru", "Summary": "ru"}),
        columns_source("chemistry_shelves", 1, {"text": "en"}),
        columns_source("fantasy_texts", 1, {"text": "ru"}),
        SourceSpec("fan_fiction", 2, "text", _fan_fiction),
        SourceSpec("poetry_lines", 1, "text", _poetry),
        columns_source(
            "story_pairs", 1, {"text_ru": "ru", "text_en": "en", "summary_ru": "ru", "summary_en": "en"}
        ),
        SourceSpec("stories", 1, "text", _stories),
        SourceSpec("subtitles", 1, "text", _subtitles),
        columns_source("toki_pona", 1, {"translated_text": "tok"}),
        SourceSpec("wiki_reading", 2, "text", _wiki_reading(detector)),
        SourceSpec("encyclopedia", 3, "text", _encyclopedia(encyclopedia_caps or {}), subset_column="lang"),
    ]
