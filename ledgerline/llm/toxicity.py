"""Toxicity as ordered severity grades: a cumulative-link model over sparse text features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shingles import Words, batches
from ledgerline.llm.store import small, written

BITS = 40  # of a hashed feature
STEMS = (4, 5, 6)  # bytes of a word's beginning that are features besides the whole word
GRADES = 3  # above grade 0
RATIO = 5


@dataclass(frozen=True)
class Model:
    """P(grade >= j) = logistic(sum of weights - thresholds[j - 1]); thresholds rise, weights are shared."""

    features: np.ndarray  # ascending
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, text: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """The sum of the weights of each of n texts' features."""
        if not len(self.features):
            return np.zeros(n)
        may = np.zeros(1 << 16, bool)
        may[self.features & 0xFFFF] = True
        held = np.flatnonzero(may[feature & 0xFFFF])
        at = np.minimum(np.searchsorted(self.features, feature[held]), len(self.features) - 1)
        found = self.features[at] == feature[held]
        return np.bincount(text[held[found]], weights=self.weights[at[found]], minlength=n)

    def above(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -500, 500)))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature): the distinct hashed words and word beginnings of each text, ascending."""
    words = Words(texts)
    parts = [words.hash, *[words.prefix(n)[words.end - words.start > n] + np.uint64(n) for n in STEMS]]
    of = [words.text, *[words.text[words.end - words.start > n] for n in STEMS]]
    both = np.concatenate([(t.astype(np.uint64) << np.uint64(BITS)) | (p >> np.uint64(64 - BITS)) for t, p in zip(of, parts)])
    both = np.unique(both)
    return (both >> np.uint64(BITS)).astype(np.int64), (both & np.uint64((1 << BITS) - 1)).astype(np.int64)


def train(examples: list[tuple[int, np.ndarray]], keep: int = 1 << 13, rounds: int = 300) -> Model:
    """examples: (toxic 0 or 1, feature numbers).

    Features: the `keep` most telling by the difference of their shares in toxic and other texts, in standard errors, if
    over 4 and if toxic texts have them RATIO times as often. Grades of toxic texts are the thirds of their number of such
    features; other texts have grade 0.
    """
    y = np.array([t for t, _ in examples])
    none = Model(np.zeros(0, np.int64), np.zeros(0), np.full(GRADES, np.inf))
    if not y.any():
        return none
    row = np.repeat(np.arange(len(y)), [len(f) for _, f in examples])
    names, column = np.unique(np.concatenate([f for _, f in examples]), return_inverse=True)
    with_, all_ = (np.bincount(column[m], minlength=len(names)).astype(float) for m in (y[row] == 1, slice(None)))
    m, n = y.sum(), max((1 - y).sum(), 1)
    p, q = with_ / m, (all_ - with_) / n
    pooled = all_ / len(y)
    z = (p - q) / np.sqrt(pooled * (1 - pooled) * (1 / m + 1 / n) + 1e-12)
    chosen = np.argsort(-z, kind="stable")[:keep]
    chosen = np.sort(chosen[(z[chosen] > 4) & (p[chosen] > RATIO * q[chosen])])
    if not len(chosen):
        return none
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    row, column = row[place[column] >= 0], place[column[place[column] >= 0]]
    telling = np.bincount(row, minlength=len(y))
    cuts = np.quantile(telling[y == 1], np.arange(1, GRADES) / GRADES)
    grade = np.where(y == 1, 1 + np.searchsorted(cuts, telling, side="left"), 0)
    over = (grade[:, None] > np.arange(GRADES)).astype(float)
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / max(1 - y.mean(), 1e-9))[:, None] / len(y)
    weights, first, gaps = np.zeros(len(chosen)), 1.0, np.zeros(GRADES - 1)  # thresholds: first, then steps of exp(gaps)
    state = [[np.zeros_like(np.asarray(v, float)), np.zeros_like(np.asarray(v, float))] for v in (weights, first, gaps)]
    for step in range(1, rounds + 1):
        steps = np.exp(gaps)
        thresholds = first + np.concatenate([[0], np.cumsum(steps)])
        score = np.bincount(row, weights=weights[column], minlength=len(y))
        wrong = (1 / (1 + np.exp(-np.clip(score[:, None] - thresholds, -500, 500))) - over) * balance
        down = wrong.sum(0)
        slopes = [np.bincount(column, weights=wrong.sum(1)[row], minlength=len(chosen)) + 1e-4 * weights,
                  -down.sum(), np.array([-down[i + 1 :].sum() for i in range(GRADES - 1)]) * steps]
        moved = []
        for value, slope, (mean, square) in zip((weights, first, gaps), slopes, state):
            mean[...] = 0.9 * mean + 0.1 * slope
            square[...] = 0.999 * square + 0.001 * slope**2
            moved.append(value - 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9))
        weights, first, gaps = moved
    return Model(names[chosen], weights, first + np.concatenate([[0], np.cumsum(np.exp(gaps))]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 3000) -> Model:
    """Learns from a bounded sample of about `sample` toxic and as many other labelled texts, chosen by a hash of their id.

    Labels of one document that disagree count as toxic; labels without doc_id or toxic are left out.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        "doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in marks.groupBy("toxic").count().collect()}
    rate = F.when(F.col("toxic") == 1, min(1.0, sample / max(sizes.get(1, 0), 1))).otherwise(min(1.0, sample / max(sizes.get(0, 0), 1)))
    marks = small(written(marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < rate * (1 << 30)), "marks"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(marks, "doc_id").select("toxic", "text")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            text, feature = features(batch.column(1))
            first = np.searchsorted(text, np.arange(batch.num_rows + 1))
            packed = [feature[a:b].astype("<i8").tobytes() for a, b in zip(first, first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["toxic", "features"])

    found = rows.mapInArrow(run, "toxic int, features binary").collect()  # the bounded sample
    return train([(r.toxic, np.frombuffer(bytes(r.features), "<i8")) for r in found])


def severity(docs: DataFrame, labels: DataFrame, sample: int = 3000) -> DataFrame:
    """Per row of docs: doc_id, severity (expected grade, 0 to GRADES), grade (most probable), toxic_probability, toxic.

    One weight for each hashed word or word beginning is shared by the thresholds of all grades (cumulative logits). Texts
    are read whole; each feature counts once for a text. Null and empty texts have no features: their grade is 0. Without
    toxic labels everything is grade 0. Repeated rows keep their rows, a null doc_id stays null; an empty table gives
    no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches(stream):
            text, feature = features(batch.column(1))
            score = model.scores(text, feature, batch.num_rows)
            above = model.above(score)
            exactly = -np.diff(np.concatenate([np.ones((len(score), 1)), above, np.zeros((len(score), 1))], 1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above.sum(1)), pa.array(exactly.argmax(1).astype(np.int32)), pa.array(above[:, 0]), pa.array(above[:, 0] >= 0.5)],
                names=["doc_id", "severity", "grade", "toxic_probability", "toxic"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, severity double, grade int, toxic_probability double, toxic boolean")
