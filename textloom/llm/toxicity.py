"""Toxicity: a weighted grammar of small transducers, applied to clauses.

Words fall into classes: INSULT, THREAT, TARGET, NEGATION, REPORT and OTHER.  Five
transducers read the classes of a clause from left to right:

* insult   passes an insult's weight on, half more right after another one,
* threat   passes a threat's weight on, halved from the second one of a clause on,
* target   doubles what comes within a few words after an addressed person, and a
           threat without one counts for little,
* negation damps what comes within three words after a negation,
* report   damps what comes after a verb of speech up to the end of the clause.

``compose`` builds their product once as a transition table; the weight of a clause
is the sum of its arcs' weights.  The score of a text is a logistic function of the
summed, the largest and the relative clause weight.

Insult stems and the weights of insults and threats are learned from labelled rows: word beginnings that
occur in toxic texts far more often than chance allows; of nested beginnings that occur equally often only the longest
counts, so that no other word that begins alike is taken for an insult.  Threats and verbs of speech come from lists, in their
inflected forms; a threat without a learned weight has a fixed one.  A text is first searched by
one automaton for all stems (linear in its length); only clauses with a hit are parsed.

Defined cases: a null text counts as empty; empty texts and texts without a hit get
the score of "no evidence"; repeated rows are scored like any other; without usable
labels (none, or one class only) a short seed list and fixed coefficients apply;
a null ``doc_id`` is scored and never used for learning.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import blocks, by_place, held_out, pick, stored
from textloom.llm.logistic import fit_logistic

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

# word lists of the grammar, English with the most common words of three more languages
SEED_INSULTS = "idiot moron scum loser stupid pathetic worthless disgusting trash clown imbecile dumbass".split()
THREAT_VERBS = "kill murder strangle stab slaughter exterminate lynch behead torture poison drown butcher".split()
OTHER_THREATS = "shoot shoots shooting töten erschießen ermorden umbringen erwürgen tuer égorger assassiner étrangler matar asesinar degollar estrangular".split()
TARGETS = "you your u yourself he she they him her them these those du dich ihr sie tu vous toi usted ellos".split()
NEGATIONS = "not never no nor isn't aren't don't wasn't without nicht kein keine nie ne pas jamais nunca".split()
REPORT_VERBS = "claim call quote report shout reply".split()
OTHER_REPORTS = "said says say saying tell tells telling told wrote writes write written according sagte sagt schrieb schreibt dit écrit dijo dice escribió".split()


def inflected(verb: str) -> list[str]:
    """An English verb with its regular endings: a last e falls, the last consonant of a short syllable doubles."""
    short = verb[:-1] if verb.endswith("e") else verb
    if re.search(r"^[^aeiou]*[aeiou][bdgmnpt]$", verb):
        short = verb + verb[-1]
    plural = verb + ("es" if verb.endswith(("ch", "sh", "s", "x")) else "s")
    if re.search(r"[^aeiou]y$", verb):
        short, plural = verb[:-1] + "i", verb[:-1] + "ies"
    going = (verb if short.endswith("i") else short) + "ing"
    return [verb, plural, short + "ed", going]


THREATS = [*(form for verb in THREAT_VERBS for form in inflected(verb)), *OTHER_THREATS]
REPORTS = [*(form for verb in REPORT_VERBS for form in inflected(verb)), *OTHER_REPORTS]

LETTERS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_END = re.compile(r"[.!?;:\n]+")
SEED_WEIGHT = 2.0
MIN_Z = 7.0
MIN_PRECISION = 0.5


# ------------------------------------------------------------- transducers
@dataclass(frozen=True)
class Transducer:
    """States 0..n-1; ``step(state, symbol) -> (next state, factor)``."""

    states: int
    step: object
    name: str = ""


def _insult(state: int, symbol: int) -> tuple[int, float]:
    """An insult right after another one counts half more."""
    return (1, 1.5 if state else 1.0) if symbol == INSULT else (0, 1.0)


def _threat(state: int, symbol: int) -> tuple[int, float]:
    """Repeated threats in one clause count half each from the second on."""
    return (1, 0.5 if state else 1.0) if symbol == THREAT else (state, 1.0)


TARGET_SPAN, NEGATION_SPAN = 4, 3


def _target(state: int, symbol: int) -> tuple[int, float]:
    if symbol == TARGET:
        return TARGET_SPAN, 1.0
    factor = 2.0 if state else (0.25 if symbol == THREAT else 1.0)
    return max(0, state - 1), factor


def _negation(state: int, symbol: int) -> tuple[int, float]:
    if symbol == NEGATION:
        return NEGATION_SPAN, 1.0
    return max(0, state - 1), 0.4 if state else 1.0


def _report(state: int, symbol: int) -> tuple[int, float]:
    return (1, 1.0) if symbol == REPORT else (state, 0.6 if state else 1.0)


MACHINES = (
    Transducer(2, _insult, "insult"),
    Transducer(2, _threat, "threat"),
    Transducer(TARGET_SPAN + 1, _target, "target"),
    Transducer(NEGATION_SPAN + 1, _negation, "negation"),
    Transducer(2, _report, "report"),
)


@lru_cache(maxsize=4)
def compose(machines: tuple[Transducer, ...] = MACHINES) -> tuple[list[list[int]], list[list[float]]]:
    """The product machine: next state and arc factor by state and symbol; state 0 is the start."""
    start = (0,) * len(machines)
    number, queue = {start: 0}, [start]
    following: list[list[int]] = []
    factors: list[list[float]] = []
    while len(following) < len(queue):
        here = queue[len(following)]
        row, arcs = [], []
        for symbol in range(6):
            moves = [m.step(s, symbol) for m, s in zip(machines, here, strict=True)]
            there = tuple(m[0] for m in moves)
            if there not in number:
                number[there] = len(queue)
                queue.append(there)
            row.append(number[there])
            arcs.append(math.prod(m[1] for m in moves) if symbol in (INSULT, THREAT) else 0.0)
        following.append(row)
        factors.append(arcs)
    return following, factors


# ------------------------------------------------------------------- model
@dataclass(frozen=True)
class ToxicityModel:
    """Weights by stem (a word beginning), whole words ending in a blank, and the coefficients of the score."""

    stems: dict[str, float] = field(default_factory=dict)
    coefficients: tuple[float, ...] = (-4.0, 2.0, 1.0, 0.5)


CLASSES = {
    **{w: TARGET for w in TARGETS},
    **{w: NEGATION for w in NEGATIONS},
    **{w: REPORT for w in REPORTS},
    **{w: THREAT for w in THREATS},
}


def features_of_word(word: str) -> list[str]:
    """Beginnings of four to six letters; a shorter word counts as a whole, marked by a blank."""
    return [word[:k] for k in range(4, min(6, len(word)) + 1)] if len(word) >= 4 else [word + " "]


class Matcher:
    """A model made ready in a worker."""

    def __init__(self, model: ToxicityModel) -> None:
        # whole words of the lists are looked up as such, learned beginnings by ``features_of_word``
        self.weights = {**{w: SEED_WEIGHT for w in SEED_INSULTS if len(w) >= 4}, **model.stems}
        self.threats = {w: max((model.stems[f] for f in features_of_word(w) if f in model.stems), default=SEED_WEIGHT) for w in THREATS}
        self.coefficients = np.array(model.coefficients)
        self.following, self.factors = compose()
        self.automaton = ahocorasick.Automaton()
        for stem in {*self.weights, *THREATS}:
            self.automaton.add_word(stem.strip(), len(stem.strip()))
        self.automaton.make_automaton()

    def weight(self, word: str) -> float:
        best = self.weights.get(word, 0.0)
        for feature in features_of_word(word):
            best = max(best, self.weights.get(feature, 0.0))
        return best

    def clause(self, clause: str) -> float:
        state, total = 0, 0.0
        for word in LETTERS.findall(clause):
            symbol, weight = CLASSES.get(word, OTHER), 0.0
            if symbol == THREAT:
                weight = self.threats[word]
            elif symbol == OTHER and (weight := self.weight(word)):
                symbol = INSULT
            total += weight * self.factors[state][symbol]
            state = self.following[state][symbol]
        return total

    def matched(self, text: str) -> list[tuple[int, int, float]]:
        """Clauses with their place in the lower-cased text and their weight, in order."""
        low = text.lower()
        out: list[tuple[int, int, float]] = []
        done = -1
        for end, length in self.automaton.iter(low):
            start = end - length + 1
            if start < done or (start and low[start - 1].isalpha()):
                continue
            # a clause begins after the end of the one before: no place is searched twice
            before = max(low.rfind(c, max(done, 0), start) for c in ".!?;:\n") + 1
            after = CLAUSE_END.search(low, end)
            done = after.start() if after else len(low)
            weight = self.clause(low[before:done])
            if weight:
                out.append((before, done, weight))
        return out

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        if not text:
            return 0.0, 0.0, 0.0
        weights = [w for _, _, w in self.matched(text)]
        if not weights:
            return 0.0, 0.0, 0.0
        total = sum(weights)
        return math.log1p(total), min(max(weights), 20.0), math.log1p(1000 * total / (len(text) + 100))

    def score(self, text: str | None) -> float:
        x = self.coefficients[0] + float(np.dot(self.coefficients[1:], self.evidence(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, x))))


# ---------------------------------------------------------------- learning
def labelled_sample(labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label) of the rows open to learning, about ``per_class`` rows of each class at most; counts of all such rows.

    The choice follows a hash of the id, with a share per class from the counts of all labels.
    """
    known = (
        pick(labels, doc_id="long", label=(label, "int"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    million = 1_000_000
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(million))
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col("label") == value) & (place < math.ceil(million * min(1.0, per_class / n))))
    return known.where(keep), counts


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word beginning of each text once, with the text's label and a sketch shared by its near copies."""
    import xxhash

    for batch in blocks(batches, "text"):
        names, groups, labels = [], [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words = LETTERS.findall((text or "").lower())
            distinct = set(words)
            if not distinct:
                continue
            sketch = min(xxhash.xxh64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2)))
            found = {f for w in distinct for f in features_of_word(w)}
            names += found
            groups += [sketch - (1 << 63)] * len(found)
            labels += [label] * len(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(groups, pa.int64()), pa.array(labels, pa.int32())],
            ["feature", "sketch", "label"],
        )


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 6000, max_stems: int = 4096) -> ToxicityModel:
    """Fit stems and coefficients on a bounded sample of labelled texts (``per_class`` rows of each label).

    A stem must be far over chance in toxic texts; near copies of a text count once
    (their sketch, a minimum hash of three-word shingles, is mostly the same).  At most
    ``max_stems`` stems, the most significant first, reach the driver.
    """
    sample, all_labelled = labelled_sample(labels, "toxic", per_class)
    texts = pick(docs, doc_id="long", text="string").join(F.broadcast(sample), "doc_id").select("text", "label")
    texts = stored(texts, "toxicity-sample").repartition(docs.sparkSession.sparkContext.defaultParallelism * 2)
    counted = texts.mapInArrow(_occurrences, "feature string, sketch long, label int").distinct()
    sizes = texts.groupBy("label").agg(F.count("*").alias("n")).collect()
    n = {r["label"]: r["n"] for r in sizes}
    if not n.get(0) or not n.get(1):
        return ToxicityModel()
    base = n[1] / (n[0] + n[1])
    stems = counted.groupBy("feature").agg(
        F.count(F.when(F.col("label") == 1, 1)).alias("pos"), F.count(F.when(F.col("label") == 0, 1)).alias("neg")
    )
    seen = F.col("pos") + F.col("neg")
    z = (F.col("pos") - seen * base) / F.sqrt(seen * (base * (1 - base)))
    odds = F.log(((F.col("pos") + 0.5) / (n[1] + 1.0)) / ((F.col("neg") + 0.5) / (n[0] + 1.0)))
    chosen = (
        stems.where((z >= MIN_Z) & (F.col("pos") >= MIN_PRECISION * seen))
        .select("feature", F.least(odds, F.lit(6.0)).alias("weight"), z.alias("z"), seen.alias("seen"))
        .orderBy(F.desc("z"), "feature")
        .limit(max_stems)
        .collect()
    )
    longer = {(r["feature"][:-1], r["seen"]) for r in chosen if not r["feature"].endswith(" ")}
    stems_found = {r["feature"]: float(r["weight"]) / 3.0 for r in chosen if (r["feature"], r["seen"]) not in longer}

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = matcher_of(ToxicityModel(stems_found))
        for batch in blocks(batches, "text"):
            rows = [ready.evidence(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array(c, pa.float64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("label")], ["a", "b", "c", "label"])

    rows = texts.mapInArrow(evidence, "a double, b double, c double, label int").toPandas()
    x, y = rows[["a", "b", "c"]].to_numpy(), rows["label"].to_numpy(dtype=float)
    # sampled classes are weighted back to their frequency in all labelled rows
    balance = np.where(y == 1, all_labelled[1] / max(1, (y == 1).sum()), all_labelled[0] / max(1, (y == 0).sum()))
    balance *= len(y) / balance.sum()
    return ToxicityModel(stems_found, tuple(fit_logistic(x, y, balance, penalty=1.0)))


_READY: dict[int, Matcher] = {}


def matcher_of(model: ToxicityModel) -> Matcher:
    """One automaton per worker and model."""
    key = hash((tuple(sorted(model.stems.items())), model.coefficients))
    if key not in _READY:
        _READY.clear()
        _READY[key] = Matcher(model)
    return _READY[key]


# ----------------------------------------------------------------- scoring
def toxicity_score(spark, model: ToxicityModel):  # noqa: ANN001, ANN201
    """A column function ``text -> score`` between 0 and 1."""
    shipped = spark.sparkContext.broadcast(model)  # at most ``max_stems`` stems

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        ready = matcher_of(shipped.value)
        return pd.Series([ready.score(t) for t in texts], dtype="float64")

    return score


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    scored = pick(docs, doc_id="long", text="string").withColumn(
        "score", toxicity_score(docs.sparkSession, model)("text")
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold; columns and all other rows stay."""
    placed, name_of = by_place(docs)
    score = toxicity_score(docs.sparkSession, model)
    return placed.where(score(F.col(name_of("text")).cast("string")) < threshold).toDF(*docs.columns)
