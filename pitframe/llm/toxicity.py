"""Toxicity as ordinal regression: a cumulative-link model of severity grades on sparse text features.

The labels table says toxic or not. Severity grades are made from it: clean rows have grade 0, and toxic rows are graded 1 to 3 by
thirds of how many marker words they hold, a marker being a word of several toxic rows and of no clean one in the sample.
The model is P(grade > k) = logistic(w . x - threshold k) with one weight vector for all thresholds. An L1 penalty
chooses the features, so that most words have no weight; those that stay are fitted again without it. x counts, for each feature (a word, or the first four or five letters of one), the
document's distinct words that have it; the score of a document is therefore a sum over its distinct words.

The model is fitted on a bounded sample of labelled rows, ``Fit.rows`` of each class chosen by a hash of the id, weighted by how
many rows of the class there are. The sample's features are counted on Spark; the driver sees the number of marker words of each
row, the ``Fit.features`` chosen features and their counts in the rows, however long the texts are. Scoring reads every document,
whole, in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.llm.shingles import chunks
from pitframe.sources.tables import materialise

WORD = re.compile(r"[^\W_]+")
SAMPLE = "doc_id bigint, toxic int, n_words int, features array<string>, counts array<int>"
RESULT = "doc_id bigint, score double, p_toxic double, expected_severity double, severity int, toxic boolean, n_grades int"


@dataclass(frozen=True)
class Fit:
    rows: int = 3000  # labelled rows of each class at most
    features: int = 1500
    least_rows: int = 6  # toxic rows that a feature must be in
    steps: int = 300
    rate: float = 0.05
    l1: float = 5e-4
    least_weight: float = 0.2  # of a feature that stays


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: np.ndarray


def words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features(word: str) -> tuple[str, ...]:
    result = [word]
    if len(word) > 4:
        result.append(f"{word[:4]}*")
    if len(word) > 5:
        result.append(f"{word[:5]}*")
    return tuple(result)


def _counted(text: str) -> tuple[int, Counter]:
    """The number of distinct words, and for each feature how many of them have it."""
    own = sorted(words(text))
    return len(own), Counter(f for w in own for f in features(w))


def _sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch):
            counted = [_counted(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("toxic"), pa.array([n for n, _ in counted], pa.int32()),
                 pa.array([list(c.keys()) for _, c in counted], pa.list_(pa.string())), pa.array([list(c.values()) for _, c in counted], pa.list_(pa.int32()))],
                ["doc_id", "toxic", "n_words", "features", "counts"])


def labelled_sample(docs: DataFrame, labels: DataFrame, fit: Fit) -> tuple[DataFrame, dict[int, int]]:
    """The sampled rows, written, with a number (``row``) and their counted features, and the number of labelled documents of each class.
    A document that is labelled several times counts once, as toxic if one label says so."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    by_hash = [F.md5(F.col("doc_id").cast("string")), "doc_id"]
    picked = [known.where(F.col("toxic") == c).orderBy(*by_hash).limit(fit.rows) for c in (0, 1)]
    ids = picked[0].unionByName(picked[1])  # at most twice fit.rows ids
    held = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").where("text IS NOT NULL")
    return materialise(held.mapInArrow(_sample_batches, SAMPLE).withColumn("row", F.monotonically_increasing_id()), "toxicity-sample"), counts


def grades(hits: np.ndarray, n_words: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0 for clean rows; from 1 up for toxic ones, by thirds of their number of marker words and, among equal ones, of their rate."""
    measure = np.c_[hits, hits / np.maximum(1, n_words)]
    place = np.unique(measure, axis=0, return_inverse=True)[1].ravel()  # equal rows share a place
    cuts = np.quantile(place[toxic == 1], [1 / 3, 2 / 3], method="lower") if toxic.any() else [0, 0]
    grade = np.where(toxic == 1, 1 + (place > cuts[0]) + (place > cuts[1]), 0)
    return np.unique(grade, return_inverse=True)[1]  # without empty grades


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_sample(sample: DataFrame, counts: dict[int, int], fit: Fit = Fit()) -> Model | None:
    """From the rows of ``labelled_sample``. None where one of the classes has no row: nothing can be learnt, every document then has
    severity 0."""
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return None
    each = sample.select("row", "toxic", F.explode(F.arrays_zip("features", "counts")).alias("z")).select("row", "toxic", "z.*").withColumnRenamed("features", "feature")
    seen = each.groupBy("feature").agg(F.sum("toxic").alias("in_toxic"), F.sum(1 - F.col("toxic")).alias("in_clean"))
    seen = materialise(seen.where(F.col("in_toxic") >= fit.least_rows), "toxicity-features")
    # words have no star
    markers = seen.where((F.col("in_clean") == 0) & ~F.endswith("feature", F.lit("*"))).select("feature")
    hits = each.join(markers, "feature").groupBy("row").agg(F.count("*").alias("hits"))
    rows = sample.select("row", "doc_id", "toxic", "n_words").join(hits, "row", "left").fillna(0, "hits").toArrow().sort_by([("doc_id", "ascending"), ("row", "ascending")])
    names, toxic, n_words, n_hits = (rows[c].to_numpy() for c in ("row", "toxic", "n_words", "hits"))
    grade = grades(n_hits, n_words, toxic)
    # the features that tell the classes apart best, each on its own
    apart = F.abs(F.log((F.col("in_toxic") + 0.5) / (n1 + 1)) - F.log((F.col("in_clean") + 0.5) / (n0 + 1))) * F.sqrt(F.col("in_toxic") + F.col("in_clean"))
    kept = [r["feature"] for r in seen.orderBy(apart.desc(), "feature").limit(fit.features).select("feature").collect()]
    numbers = sample.sparkSession.createDataFrame([*zip(kept, range(len(kept)))], "feature string, number int")
    met = each.join(F.broadcast(numbers), "feature").select("row", "number", "counts").toArrow()
    place = np.argsort(names)
    row, column = place[np.searchsorted(names, met["row"].to_numpy(), sorter=place)], met["number"].to_numpy()
    order = np.lexsort((column, row))
    return _fitted(grade, toxic, kept, row[order], column[order], met["counts"].to_numpy().astype(float)[order], counts, fit)


def fit_model(rows: list[tuple[str, int]], counts: dict[int, int], fit: Fit = Fit()) -> Model | None:
    """``fit_sample`` for (text, toxic) rows at hand."""
    toxic = np.array([t for _, t in rows], int)
    if not len(rows) or not toxic.any() or toxic.all():
        return None
    sizes, seen = zip(*[_counted(text) for text, _ in rows], strict=True)
    in_toxic, in_clean = Counter(), Counter()
    for own, t in zip(seen, toxic, strict=True):
        (in_toxic if t else in_clean).update(own.keys())
    n1, n0 = int(toxic.sum()), int(len(toxic) - toxic.sum())
    markers = {f for f, n in in_toxic.items() if n >= fit.least_rows and f not in in_clean and not f.endswith("*")}
    grade = grades(np.array([len(own.keys() & markers) for own in seen]), np.array(sizes), toxic)

    def apart(f: str) -> float:
        return abs(np.log((in_toxic[f] + 0.5) / (n1 + 1)) - np.log((in_clean[f] + 0.5) / (n0 + 1))) * np.sqrt(in_toxic[f] + in_clean[f])

    kept = sorted((f for f, n in in_toxic.items() if n >= fit.least_rows), key=lambda f: (-apart(f), f))[: fit.features]
    number = {f: i for i, f in enumerate(kept)}
    met = np.array([(i, number[f], n) for i, own in enumerate(seen) for f, n in own.items() if f in number], np.int64).reshape(-1, 3)
    return _fitted(grade, toxic, kept, met[:, 0], met[:, 1], met[:, 2].astype(float), counts, fit)


def _fitted(grade: np.ndarray, toxic: np.ndarray, kept: list[str], row: np.ndarray, column: np.ndarray, value: np.ndarray, counts: dict[int, int], fit: Fit) -> Model:
    """The model of the ``kept`` features, of which ``row`` has ``value`` times the one numbered ``column``."""
    n1, n0, n = int(toxic.sum()), int(len(toxic) - toxic.sum()), len(toxic)
    weight = np.where(toxic == 1, counts.get(1, n1) / n1, counts.get(0, n0) / n0)
    weight = weight / weight.sum()

    w = np.zeros(len(kept))
    steps = int(grade.max())
    cut = np.r_[1.0, np.zeros(steps - 1)]  # the first threshold and the logarithms of the steps to the next ones
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, cut)]
    for step in range(1, 2 * fit.steps + 1):
        if step == fit.steps + 1:  # the penalty has chosen the features; their weights are now fitted without it
            support = np.abs(w) >= fit.least_weight
            w[~support] = 0
            moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, cut)]
        thresholds = np.r_[cut[0], cut[0] + np.cumsum(np.exp(cut[1:]))]
        z = np.bincount(row, value * w[column], n)[:, None] - thresholds
        above = np.c_[np.ones(n), _logistic(z), np.zeros(n)]  # P(grade >= k)
        slope = np.c_[np.zeros(n), above[:, 1:-1] * (1 - above[:, 1:-1]), np.zeros(n)]
        at = np.arange(n)
        p = np.maximum(above[at, grade] - above[at, grade + 1], 1e-12)
        by_low, by_high = weight * slope[at, grade] / p, -weight * slope[at, grade + 1] / p
        by_z = by_low + by_high
        by_threshold = np.array([-(by_low[grade == k + 1].sum() + by_high[grade == k].sum()) for k in range(steps)])
        later = np.cumsum(by_threshold[::-1])[::-1]
        by_w = np.bincount(column, value * by_z[row], len(kept))
        if step <= fit.steps:
            by_w = np.where(w != 0, by_w - fit.l1 * np.sign(w), np.sign(by_w) * np.maximum(np.abs(by_w) - fit.l1, 0))
        else:
            by_w = np.where(support, by_w, 0)
        gradients = (by_w, np.r_[later[0], later[1:] * np.exp(cut[1:])])
        before = w.copy()
        age = step if step <= fit.steps else step - fit.steps
        for parameter, g, (m, v) in zip((w, cut), gradients, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            parameter += fit.rate * (m / (1 - 0.9**age)) / (np.sqrt(v / (1 - 0.99**age)) + 1e-8)
        w[before * w < 0] = 0  # a weight that changes sides stops at zero
    thresholds = np.r_[cut[0], cut[0] + np.cumsum(np.exp(cut[1:]))]
    return Model({f: float(x) for f, x in zip(kept, w, strict=True) if x}, thresholds)


def predict(scores: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(grade >= 1), expected grade and most likely grade."""
    above = _logistic(scores[:, None] - thresholds)
    each = np.c_[np.ones(len(scores)), above] - np.c_[above, np.zeros(len(scores))]
    return above[:, 0], above.sum(1), each.argmax(1)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per input row: doc_id, score, p_toxic, expected_severity, severity, toxic (p_toxic at least one half),
    n_grades (grades above clean that the model tells apart; 0 without a model).

    A null text counts as empty: it has score 0. Repeated rows are scored one by one; an empty table gives an empty result;
    columns other than doc_id and text are not read.
    """
    weights, thresholds = (model.weights, model.thresholds) if model else ({}, np.array([40.0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            for part in chunks(batch):
                totals = []
                for text in part.column("text").to_pylist():
                    own = []
                    for word in words(text or ""):
                        s = known.get(word)
                        if s is None:
                            s = known[word] = sum(weights.get(f, 0.0) for f in features(word))
                        if s:
                            own.append(s)
                    totals.append(sum(sorted(own)))
                if len(known) > 300_000:
                    known.clear()
                scores = np.array(totals, float)
                p, expected, severity = predict(scores, thresholds)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores.round(6)), pa.array(p.round(6)), pa.array(expected.round(6)), pa.array(severity.astype(np.int32)), pa.array(p >= 0.5),
                     pa.array(np.full(len(scores), len(thresholds) if model else 0, np.int32))],
                    ["doc_id", "score", "p_toxic", "expected_severity", "severity", "toxic", "n_grades"])

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def toxicity(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """Fit on the labelled sample and score all documents."""
    return score(docs, fit_sample(*labelled_sample(docs, labels, fit), fit))
