"""Quality by co-training of two views of a document.

* content view: what the text is written with: shares of hashed three-byte windows and of kinds of characters, and
  how often words repeat;
* metadata view: what is known about the page without its wording: language, source, length, and the layout of its
  lines (their number and length, empty, short, repeated and finished ones).  It sees no letter, digit or word.

Both views get a logistic classifier, fitted on a bounded, documented sample of labelled rows, and calibrated on
labelled rows it was not fitted on.  Then, for some rounds, each classifier labels the rows of a bounded unlabelled
sample it is most sure of after calibration, and the *other* one learns from them.  Each view keeps the round whose
loss on its calibration rows is lowest, so an exchange that does harm is not kept.  The score of a document is the
mean of both calibrated log-odds.  All documents are scored over their whole texts.

Defined cases: null texts count as empty and are scored; null languages and sources are values of their own;
repeated rows are scored alike; without labels of both classes every document scores 1 (nothing is known
against it); a null ``doc_id`` is scored and never used for learning; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import blocks, by_place, held_out, pick, stored
from textloom.llm.logistic import fit_logistic, sigmoid
from textloom.llm.toxicity import labelled_sample

HASHED = 1024
CLASSES = 8
CONTENT = HASHED + 3 + CLASSES
META = 9
NAMED = 32  # hash places of languages and sources

# classes of bytes: other, blank, line break, lower, upper, digit, common marks, other marks; bytes above 127 count as lower
BYTE_CLASS = np.zeros(256, dtype=np.int64)
BYTE_CLASS[[9, 11, 12, 13, 32]] = 1
BYTE_CLASS[10] = 2
BYTE_CLASS[97:123] = 3
BYTE_CLASS[128:] = 3
BYTE_CLASS[65:91] = 4
BYTE_CLASS[48:58] = 5
BYTE_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 6
BYTE_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 7


def content_view(text: str) -> np.ndarray:
    """Hashed three-byte windows as shares (square roots), three figures of word repetition, shares of kinds of characters."""
    data = np.frombuffer(text.encode(), dtype=np.uint8).astype(np.uint32)
    out = np.zeros(CONTENT, dtype=np.float32)
    if len(data):
        out[HASHED + 3 :] = np.bincount(BYTE_CLASS[data], minlength=CLASSES) / len(data)
    if len(data) >= 3:
        windows = (data[:-2] * np.uint32(0x9E3779B1)) ^ (data[1:-1] * np.uint32(0x85EBCA6B)) ^ (data[2:] * np.uint32(0xC2B2AE35))
        counts = np.bincount((windows >> np.uint32(22)).astype(np.int64) & (HASHED - 1), minlength=HASHED)
        out[:HASHED] = np.sqrt(counts / counts.sum())
    words = text.split()
    if words:
        out[HASHED] = len(set(words)) / len(words)
        same = sum(a == b for a, b in zip(words, words[1:], strict=False))
        out[HASHED + 1] = same / len(words)
        out[HASHED + 2] = min(len(words) / max(1, len(data)), 1.0)
    return out


def metadata_view(text: str, lang: str | None, source: str | None) -> np.ndarray:
    """Language, source, length and layout; nothing of the wording."""
    out = np.zeros(META + 2 * NAMED, dtype=np.float32)
    lines = text.split("\n")
    sizes = np.array([len(line) for line in lines], dtype=np.float64)
    out[0], out[1] = np.log1p(len(text)) / 10, np.log1p(len(lines)) / 5
    out[2], out[3], out[4] = np.log1p(sizes.mean()) / 8, np.log1p(sizes.max()) / 8, np.log1p(sizes.std()) / 8
    out[5] = np.mean(sizes == 0)
    out[6] = len(set(lines)) / len(lines)
    out[7] = np.mean([line[-1:] in ".!?" for line in lines])
    out[8] = np.mean(sizes < 40)
    for start, value in ((META, lang), (META + NAMED, source)):
        out[start + zlib.crc32((value or "\0").encode()) % NAMED] = 1
    return out


@dataclass(frozen=True)
class Linear:
    """Standardised logistic classifier with a calibration (slope, shift) of its log-odds."""

    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.beta[1:] + self.beta[0]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * self.raw(x) + self.shift, -12, 12)


@dataclass(frozen=True)
class QualityModel:
    content: Linear | None
    metadata: Linear | None


def fit_linear(x: np.ndarray, y: np.ndarray, weights: np.ndarray, penalty: float, steps: int = 200) -> Linear:
    """By accelerated gradient descent; one pass over the sample per step."""
    mean, scale = x.mean(axis=0, dtype=np.float64), x.std(axis=0, dtype=np.float64) + 1e-3
    design = np.ones((len(x), x.shape[1] + 1), dtype=np.float32)  # the largest thing the driver holds
    np.subtract(x, mean, out=design[:, 1:], casting="same_kind")
    design[:, 1:] /= scale
    weights = (weights / weights.sum()).astype(np.float32)
    ridge = np.full(design.shape[1], penalty)
    ridge[0] = 0
    # the largest eigenvalue of the weighted design by power iteration, with some room
    vector = np.ones(design.shape[1], dtype=np.float32)
    for _ in range(30):
        vector = design.T @ (weights * (design @ vector))
        spectral = float(np.linalg.norm(vector))
        vector /= max(spectral, 1e-12)
    rate = 1.0 / (0.3 * spectral + penalty)
    beta = look = np.zeros(design.shape[1])
    for step in range(steps):
        wrong = weights * (sigmoid(design @ look.astype(np.float32)) - y)
        gradient = design.T @ wrong.astype(np.float32) + ridge * look
        following = look - rate * gradient
        look = following + step / (step + 3) * (following - beta)
        beta = following
    return Linear(mean, scale, beta)


def calibrated(model: Linear, x: np.ndarray, y: np.ndarray) -> Linear:
    """``model`` with a slope and shift fitted on rows it has not seen; few rows give a flat slope."""
    shift, slope = fit_logistic(model.raw(x)[:, None], y, penalty=0.1)
    return replace(model, slope=max(float(slope), 0.05), shift=float(shift))


def co_train(
    views: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray], rounds: int = 3, share: float = 0.1, sure: float = 0.95
) -> QualityModel:
    """Classifiers of the two ``views`` of labelled rows (``y`` 0 or 1), with an unlabelled ``pool``."""
    n = len(y)
    fold = np.arange(n) % 5 == 0  # kept for calibration
    given = [[(views[v][~fold], y[~fold], np.ones(int((~fold).sum())))] for v in (0, 1)]
    taken = [np.zeros(len(pool[0]), dtype=bool) for _ in (0, 1)]
    models, best, least = [None] * 2, [None] * 2, [np.inf, np.inf]
    for round_ in range(rounds + 1):
        for v in (0, 1):
            x, t, w = (np.concatenate(part) for part in zip(*given[v], strict=True))
            models[v] = calibrated(fit_linear(x, t, w, penalty=1e-3), views[v][fold], y[fold])
            del x
            loss = _loss(models[v], views[v][fold], y[fold])
            if loss < least[v]:
                best[v], least[v] = models[v], loss
        if round_ == rounds:
            break
        for v in (0, 1):
            if not len(pool[v]):
                continue
            p = sigmoid(models[v].log_odds(pool[v]))
            confident = np.maximum(p, 1 - p)
            for label in (0, 1):
                able = np.flatnonzero(~taken[v] & ((p >= 0.5) == label) & (confident >= sure))
                most = max(1, int(share * len(pool[v]) * max(np.mean(y == label), 0.05)))
                chosen = able[np.argsort(-confident[able], kind="stable")][:most]
                taken[v][chosen] = True
                if len(chosen):  # the other view learns from them; all rounds together weigh at most half as much as the labels
                    weight = min(0.5, 0.5 / rounds * np.sum(y[~fold] == label) / len(chosen))
                    given[1 - v].append((pool[1 - v][chosen], np.full(len(chosen), float(label)), np.full(len(chosen), weight)))
    return QualityModel(*best)


def _loss(model: Linear, x: np.ndarray, y: np.ndarray) -> float:
    odds = model.log_odds(x)
    return float(np.mean(np.logaddexp(0, odds) - y * odds))


def _sample_views(texts: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """Both views and the labels (-1: none) of a bounded sample, made in the tasks and sent as compact floats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source")), strict=True))
            made = [
                np.concatenate([content_view(t or ""), metadata_view(t or "", lang, source)]).astype(np.float16).tobytes()
                for t, lang, source in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("label"), pa.array(made, pa.binary())], ["place", "label", "views"]
            )

    rows = texts.mapInArrow(run, "place long, label int, views binary").toArrow()
    rows = rows.sort_by([("place", "ascending"), ("label", "ascending")])
    width, label = CONTENT, rows.column("label").to_numpy()
    x = np.stack([np.frombuffer(v.as_py(), dtype=np.float16) for v in rows.column("views")]) if len(label) else np.zeros((0, width + 1), np.float16)
    return [x[:, :width].astype(np.float32), x[:, width:].astype(np.float32)], label


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 3000, pool_rows: int = 4000, rounds: int = 3) -> QualityModel:
    """Fit on about ``per_class`` labelled rows of each class and ``pool_rows`` unlabelled ones (the documented bounds)."""
    sample, counts = labelled_sample(labels, "quality", per_class)
    if not counts.get(0) or not counts.get(1):
        return QualityModel(None, None)
    rows = pick(docs, doc_id="long", text="string", lang="string", source="string")
    n = rows.count()
    million = 1_000_000
    place = F.xxhash64("doc_id", F.lit(13))
    in_pool = F.pmod(F.xxhash64("doc_id", F.lit(14)), F.lit(million)) < round(million * min(1.0, pool_rows / max(1, n)))
    marked = rows.join(F.broadcast(sample), "doc_id", "left").where(F.col("doc_id").isNotNull() & (F.col("label").isNotNull() | in_pool))
    texts = marked.select(place.alias("place"), F.coalesce("label", F.lit(-1)).alias("label"), "text", "lang", "source")
    texts = stored(texts, "quality-sample").repartition(docs.sparkSession.sparkContext.defaultParallelism * 2)
    views, label = _sample_views(texts)
    known = label >= 0
    if len(set(label[known])) < 2:
        return QualityModel(None, None)
    # classes weigh as often as they are labelled
    y = label[known].astype(float)
    keep = _as_labelled(y, counts)
    labelled = [v[known][keep] for v in views]
    return co_train(labelled, y[keep], [v[~known] for v in views], rounds)


def _as_labelled(y: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Rows of the sample in an order that mixes classes evenly (calibration takes every fifth)."""
    order = np.argsort(np.where(y == 1, np.cumsum(y == 1) / max(1, (y == 1).sum()), np.cumsum(y == 0) / max(1, (y == 0).sum())), kind="stable")
    return order


SCORES = "content_score double, metadata_score double, score double"


def quality_score(spark, model: QualityModel):  # noqa: ANN001, ANN201
    """A column function (text, lang, source) -> struct of the calibrated view scores and the combined one."""
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf(SCORES)
    def score(texts: pd.Series, langs: pd.Series, sources: pd.Series) -> pd.DataFrame:
        model = shipped.value
        if model.content is None or model.metadata is None:
            return pd.DataFrame({c: np.ones(len(texts)) for c in ("content_score", "metadata_score", "score")})
        odds = [np.zeros(len(texts)), np.zeros(len(texts))]
        for start in range(0, len(texts), 256):
            part = slice(start, start + 256)
            rows = list(zip(texts[part], langs[part], sources[part], strict=True))
            odds[0][part] = model.content.log_odds(np.stack([content_view(t or "") for t, _, _ in rows]))
            odds[1][part] = model.metadata.log_odds(np.stack([metadata_view(t or "", a, b) for t, a, b in rows]))
        return pd.DataFrame(
            {"content_score": sigmoid(odds[0]), "metadata_score": sigmoid(odds[1]), "score": sigmoid((odds[0] + odds[1]) / 2)}
        )

    return score


def score_documents(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, held_out, content_score, metadata_score, score, predicted) for every row of ``docs``."""
    rows = pick(docs, doc_id="long", text="string", lang="string", source="string")
    scored = rows.withColumn("s", quality_score(docs.sparkSession, model)("text", "lang", "source"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "s.content_score",
        "s.metadata_score",
        "s.score",
        F.when(F.col("s.score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score below the threshold; columns and all other rows stay."""

    placed, name_of = by_place(docs)
    columns = [F.col(n).cast("string") if (n := name_of(c)) else F.lit(None).cast("string") for c in ("text", "lang", "source")]
    score = quality_score(docs.sparkSession, model)
    return placed.where(score(*columns)["score"] >= threshold).toDF(*docs.columns)
