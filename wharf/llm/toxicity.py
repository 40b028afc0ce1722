"""Toxicity: cumulative-link ordinal regression over sparse text features.

One weight per hashed word is shared by all ordered thresholds: P(grade <= j) is the logistic function of
threshold j minus the text's score. Trained on the driver with per-coordinate steps and an L1 penalty
(most weights end at zero, so long clean texts do not add up to a score) on a bounded sample of labelled
documents; every document then gets its expected severity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharf.llm.common import RollingHash, ready, slices, text_buffer, word_spans

BITS = 20
SAMPLE = 6000  # labelled documents that training may use
RARE = 200  # of these, drawn from each grade apart
EPOCHS = 6
GRADES = 3
STEMS = (4, 5, 6)  # first bytes of longer words, as features of their own: inflected words share them

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def grade(toxic: Column, quality: Column) -> Column:
    """Severity of a labelled document: 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    return F.when(toxic == 0, 0).when(toxic == 1, F.when(quality == 0, 2).otherwise(1))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row bounds, hashed words and stems, log counts) of every text; case and signs do not count."""
    raw, offsets = text_buffer(column)
    n = len(column)
    # words of letters only: everything else parts them
    letters = np.where(_LETTER[raw], raw, 32).astype(np.uint8)
    starts, ends, rows = word_spans(letters, offsets)
    if not len(starts):
        return np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
    rolling = RollingHash(letters, fold=True)
    parts = [rolling.spans(starts, ends) ^ np.uint64(1)]
    owner = [rows]
    for size in STEMS:
        long = ends - starts > size
        parts.append(rolling.spans(starts[long], starts[long] + size) * np.uint64(2 * size + 1))
        owner.append(rows[long])
    slot = (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)
    key = np.sort((np.concatenate(owner) << BITS) | slot)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([first, [len(key)]]))
    key = key[first]
    return np.searchsorted(key >> BITS, np.arange(n + 1)), key & ((1 << BITS) - 1), np.log1p(count)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def below(self, score: np.ndarray) -> np.ndarray:
        """P(grade <= j) for each text and threshold."""
        return 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], grades: int = GRADES, epochs: int = EPOCHS, rate: float = 1.0, l1: float = 3.0, seed: int = 3) -> Model:
    """``rows``: (slots, values, grade). Follow-the-regularised-leader steps on the shared weights, plain
    steps on the thresholds, which stay in order."""
    rng = np.random.default_rng(seed)
    z, n, w = np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros(1 << BITS)
    share = np.cumsum(np.bincount([g for *_, g in rows], minlength=grades) + 1.0)[:-1] / (len(rows) + grades)
    theta = np.log(share / (1 - share))
    for epoch in range(epochs):
        for i in rng.permutation(len(rows)):
            slots, values, g = rows[i]
            eta = float(w[slots] @ values)
            p = 1 / (1 + np.exp(-np.clip(theta - eta, -40, 40)))
            a, b = (p[g] if g < grades - 1 else 1.0), (p[g - 1] if g else 0.0)
            gradient = (1 - a - b) * values
            step = 0.05 / (1 + epoch)
            inside = max(a - b, 1e-6)
            if g < grades - 1:
                theta[g] += step * a * (1 - a) / inside
            if g:
                theta[g - 1] -= step * b * (1 - b) / inside
            theta = np.maximum.accumulate(theta)
            more = n[slots] + gradient * gradient
            z[slots] += gradient - (np.sqrt(more) - np.sqrt(n[slots])) / rate * w[slots]
            n[slots] = more
            zs = z[slots]
            w[slots] = np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((1 + np.sqrt(more)) / rate))
    return Model(w, theta)


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, exclude: Column | None = None) -> Model | None:
    """A model of the documents that ``labels`` (doc_id, quality, toxic) grades; None without any.

    At most ``sample`` documents, chosen by a hash of the id, come to the driver, each with all of its
    features. ``RARE`` of each grade are drawn from that grade alone, so that a rare grade is learned at any
    size; the others come as they fall. Of several grades of one id the worst counts. ``exclude``: documents (by doc_id) that training must not see."""
    ready(documents.sparkSession)
    graded = labels.select("doc_id", grade(F.col("toxic"), F.col("quality")).alias("grade")).dropna()
    graded = graded.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    if exclude is not None:
        graded = graded.where(~exclude)
    order = [F.xxhash64(F.lit("toxic"), "doc_id"), F.col("doc_id")]
    rare = min(RARE, sample // (2 * GRADES))
    chosen = graded.orderBy(*order).limit(sample - GRADES * rare).withColumn("_later", F.lit(1))
    for g in range(GRADES):
        chosen = chosen.unionByName(graded.where(F.col("grade") == g).orderBy(*order).limit(rare).withColumn("_later", F.lit(0)))
    chosen = chosen.groupBy("doc_id", "grade").agg(F.min("_later").alias("_later"))
    rows = documents.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bounds, slots, values = features(batch.column("text"))
            take = [slice(a, b) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), batch.column("_later"), pa.array([slots[t].astype(np.int32).tobytes() for t in take], pa.binary()), pa.array([values[t].tobytes() for t in take], pa.binary())],
                names=["doc_id", "grade", "_later", "slots", "values"],
            )

    kind = dict(documents.dtypes)["doc_id"]
    got = rows.mapInArrow(run, f"doc_id {kind}, grade int, _later int, slots binary, values binary").orderBy("_later", "doc_id", "slots").limit(sample)
    got = got.orderBy("doc_id", "slots").collect()
    rows = [(np.frombuffer(r["slots"], np.int32).astype(np.int64), np.frombuffer(r["values"]), r["grade"]) for r in got]
    return fit(rows) if rows else None


def severity(documents: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``severity`` (expected grade, 0 to 2), ``grade`` (the most probable) and ``toxic``
    (grade 1 or more is at least as probable as not) of every document, over whole texts.

    Null texts and texts without words have no feature: their severity is that of an empty text, and they
    are not called toxic. Without a model all severities are 0. Rows that repeat are judged one by one; an
    empty table gives an empty result; other columns do not matter."""
    ready(documents.sparkSession)
    if model is None:
        return documents.select("doc_id", F.lit(0.0).alias("severity"), F.lit(0).alias("grade"), F.lit(False).alias("toxic"))
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bounds, slots, values = features(batch.column("text"))
            sums = np.concatenate([[0.0], np.cumsum(model.weights[slots] * values)])
            below = model.below(sums[bounds[1:]] - sums[bounds[:-1]])
            expected = (1 - below).sum(axis=1)
            each = np.diff(np.concatenate([np.zeros((len(below), 1)), below, np.ones((len(below), 1))], axis=1), axis=1)
            toxic = (below[:, 0] <= 0.5) & (bounds[1:] > bounds[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(expected), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(toxic)],
                names=["doc_id", "severity", "grade", "toxic"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, severity double, grade int, toxic boolean")
