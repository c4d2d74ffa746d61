"""Language identification: a character-trigram model of fixed size, trained with a grouping and applied within the row.

Trigrams fall into ``SLOTS`` numbered slots, so the model has the same bounds for any vocabulary and every text is
scored in place.  Trigrams that share a slot share its counts: that is part of the model.  Scores are sums of integers
(log probabilities in millionths), so the result does not depend on the order in which Spark adds them up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.session import settle

UNKNOWN = "unknown"
SCALE = 1_000_000
# a prime; slot = (first * 104729 + second * 1299 + third) mod SLOTS, of code points
SLOTS, FIRST, SECOND = 262_139, 104_729, 1_299
# a worker holds SLOTS * MOST_LANGUAGES scores of four bytes at most
MOST_LANGUAGES = 64
FORMAT = 1
TRIGRAMS_AT_ONCE = 1 << 22
MODEL_SCHEMA = "slot long, scores array<int>"


@dataclass(frozen=True)
class LanguageModel:
    """``table(slot, scores)`` holds one score per language, in the order of ``languages``; slots never seen are missing."""

    languages: list[str]
    table: DataFrame


def _slots(text: str) -> np.ndarray:
    """The slots of all overlapping trigrams of a text, one per trigram."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    return (points[:-2] * FIRST + points[1:-1] * SECOND + points[2:]) % SLOTS


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams per (lang, slot), summed within the task as long as it meets no more labels than a model may have."""
    sums: dict[str, np.ndarray] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for lang, n in sums.items():
            slots = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slots), pa.string()), pa.array(slots), pa.array(n[slots])], ["lang", "slot", "n"]
            )
        sums.clear()

    def add(lang: str, waiting: list[np.ndarray]) -> None:
        sums[lang] += np.bincount(np.concatenate(waiting), minlength=SLOTS)

    for batch in batches:
        languages = batch.column("lang")
        for lang in pc.unique(languages).to_pylist():
            if lang not in sums:
                if len(sums) >= MOST_LANGUAGES:
                    yield from counted()
                sums[lang] = np.zeros(SLOTS, np.int64)
            waiting, held = [], 0
            for text in batch.column("text").filter(pc.equal(languages, lang)):
                found = _slots(text.as_py())
                waiting.append(found)
                held += len(found)
                if held >= TRIGRAMS_AT_ONCE:
                    add(lang, waiting)
                    waiting, held = [], 0
            if held:
                add(lang, waiting)
    yield from counted()


def train(labelled: DataFrame, most_languages: int = MOST_LANGUAGES) -> LanguageModel:
    """Smoothed log probabilities of the slots, from all texts of ``labelled(lang, text)``.

    Rows without a language or with fewer than three characters teach nothing.  Labels are the model's width, so more than
    ``most_languages`` of them are refused: such a column holds something else than languages.
    """
    texts = labelled.where(F.col("lang").isNotNull() & (F.length("text") >= 3)).select("lang", F.lower("text").alias("text"))
    found = texts.mapInArrow(_count_slots, "lang string, slot long, n long")
    counts, _ = settle(found.groupBy("lang", "slot").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang").limit(most_languages + 1).collect()
    if len(totals) > most_languages:
        raise ValueError(f"more than {most_languages} languages: clean the labels, or raise most_languages")
    if not totals:
        return LanguageModel([], labelled.sparkSession.createDataFrame([], MODEL_SCHEMA))
    seen = counts.groupBy("slot").agg(
        *[F.coalesce(F.sum(F.when(F.col("lang") == t["lang"], F.col("n"))), F.lit(0)).alias(f"_n{i}") for i, t in enumerate(totals)]
    )
    seen, used = settle(seen)

    def score(n: Column, total: int) -> Column:
        p = (n + 1).cast("double") / F.lit(float(total + used))
        return F.floor(F.log(p) * SCALE).cast("int")

    scores = [score(F.col(f"_n{i}"), t["total"]) for i, t in enumerate(totals)]
    table = seen.select("slot", F.array(*scores).alias("scores"))
    return LanguageModel([t["lang"] for t in totals], table)


def save(model: LanguageModel, path: str) -> None:
    """Store a model below ``path``.  The list of languages is written last: a model without it does not count."""
    spark = model.table.sparkSession
    model.table.write.mode("overwrite").parquet(f"{path}/scores")
    rows = [(FORMAT, SLOTS, model.languages)]
    spark.createDataFrame(rows, "format int, slots int, languages array<string>").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")


def load(spark: SparkSession, path: str) -> LanguageModel:
    """A stored model; one with other slots or of another format is refused."""
    about = spark.read.parquet(f"{path}/model").first()
    if about is None or (about["format"], about["slots"]) != (FORMAT, SLOTS):
        raise ValueError(f"{path}: not a language model of format {FORMAT} with {SLOTS} slots")
    return LanguageModel(list(about["languages"]), spark.read.schema(MODEL_SCHEMA).parquet(f"{path}/scores"))


def stored_detector(path: str) -> Callable[[DataFrame, list[str]], DataFrame]:
    """A detector for sources of unlabelled texts, by the model stored at ``path``."""
    return lambda texts, keys: detect(texts, load(texts.sparkSession, path))


def _scorer(model: LanguageModel):  # noqa: ANN202
    """A column function that labels a lower-cased text, with the whole model, whose size is fixed, in each worker."""
    table = model.table.toArrow().combine_chunks()  # SLOTS rows at most
    at = table.column("slot").to_numpy()
    seen, scores = np.zeros(SLOTS, bool), np.zeros((len(model.languages), SLOTS), dtype=np.int32)
    seen[at] = True
    # an unseen slot adds nothing
    scores[:, at] = pc.list_flatten(table.column("scores")).to_numpy().reshape(len(at), len(model.languages)).T
    shipped = model.table.sparkSession.sparkContext.broadcast((seen, scores, model.languages))

    @F.arrow_udf(T.StringType())
    def label(texts: pa.Array) -> pa.Array:
        seen, scores, languages = shipped.value

        def best(text: str | None) -> str:
            if text is None or len(text) < 3:
                return UNKNOWN
            slots = _slots(text)
            if not seen.take(slots).any():
                return UNKNOWN
            totals = [int(own.take(slots).sum(dtype=np.int64)) for own in scores]
            # the first of equals, and languages stand in order of their names
            return languages[totals.index(max(totals))]

        return pa.array(map(best, texts.to_pylist()), pa.string())

    return label


def detect(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``detected``: the best language, ``unknown`` if no trigram's slot is in the model.  No row moves."""
    if not model.languages:
        return docs.withColumn("detected", F.lit(UNKNOWN))
    return docs.withColumn("detected", _scorer(model)(F.lower("text")))
