"""Language ID: a bidirectional gated recurrent network over bytes, in numpy.

Trained on the driver by backpropagation through time on a bounded sample of labelled documents, whole
texts of which every step draws places anew; the weights (some 60 KB) travel with the task. Every position
of every text is labelled from the states of both directions, and a document's probabilities are the mean
over its positions. Texts are read whole, cut into chunks that run side by side as one batch of the network.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharf.llm.common import ready, slices, text_buffer

HIDDEN = 8
CHUNK = 64  # positions that one pass of the network sees
SAMPLE = 1600  # labelled documents that training may use, shared evenly by the languages
LEAST = 50  # of each language, if there are many
LANGUAGES = 200  # languages learned at most: those of the most documents
STEPS = 500
BATCH = 256
BYTES_AT_ONCE = 1 << 18
FOLDS = 5

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def held_out(doc_id: Column) -> Column:
    """True for the documents that training never sees: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place of tanh: several times cheaper in numpy; its slope is (1 - |result|) ** 2."""
    d = np.abs(x)
    d += np.float32(1)
    np.divide(x, d, out=x)
    return x


def _gate(x: np.ndarray) -> np.ndarray:
    """The squashed value moved from (-1, 1) to (0, 1); its slope is (1 - |2 * result - 1|) ** 2 / 2."""
    x = _squash(x)
    x *= np.float32(0.5)
    x += np.float32(0.5)
    return x


def _gate_slope(g: np.ndarray) -> np.ndarray:
    return 0.5 * (1 - np.abs(2 * g - 1)) ** 2


@dataclass
class Direction:
    """Weights of one direction: input rows per byte (3H x 256: reset, update, new), recurrent (3H x H)."""

    inputs: np.ndarray
    recurrent: np.ndarray

    def run(self, data: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States after each step, T x H x N, for bytes T x N; ``keep`` returns what training needs."""
        steps, n = data.shape
        h = self.recurrent.shape[1]
        state = np.zeros((h, n), np.float32)
        out = np.empty((steps, h, n), np.float32)
        tape = []
        for t in range(steps):
            x = np.take(self.inputs, data[t], axis=1, mode="clip")
            g = self.recurrent @ state
            gates = x[: 2 * h]
            gates += g[: 2 * h]
            gates = _gate(gates)
            reset, update = gates[:h], gates[h:]
            new = x[2 * h :]
            new += reset * g[2 * h :]
            new = _squash(new)
            if keep:
                tape.append((state, reset, update, new, g[2 * h :]))
            state = np.subtract(state, new, out=out[t])
            state *= update
            state += new
        return out, tape

    def back(self, data: np.ndarray, tape: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of (inputs, recurrent), backwards through time."""
        h = self.recurrent.shape[1]
        d_rec = np.zeros_like(self.recurrent)
        d_state = np.zeros_like(tape[0][0])
        d_xs = np.empty((3 * h, *data.shape), np.float32)
        for t in range(len(tape) - 1, -1, -1):
            before, reset, update, new, g_new = tape[t]
            d = d_out[t] + d_state
            d_update = d * (before - new) * _gate_slope(update)
            d_new = d * (1 - update) * (1 - np.abs(new)) ** 2
            d_reset = d_new * g_new * _gate_slope(reset)
            d_x = np.concatenate([d_reset, d_update, d_new])
            d_g = np.concatenate([d_reset, d_update, d_new * reset])
            d_xs[:, t] = d_x
            d_rec += d_g @ before.T
            d_state = d * update + self.recurrent.T @ d_g
        at = data.ravel()
        d_in = np.stack([np.bincount(at, d.ravel(), minlength=256) for d in d_xs]).astype(np.float32)
        return d_in, d_rec


@dataclass
class Model:
    classes: list[str]
    forward: Direction
    backward: Direction
    output: np.ndarray  # classes x 2H
    bias: np.ndarray

    def logits(self, data: np.ndarray) -> np.ndarray:
        """T x classes x N, for bytes T x N."""
        a, _ = self.forward.run(data)
        b, _ = self.backward.run(data[::-1])
        h = a.shape[1]
        return np.matmul(self.output[:, :h], a) + np.matmul(self.output[:, h:], b[::-1]) + self.bias[:, None]


def _softmax(x: np.ndarray, axis: int) -> np.ndarray:
    x = x - x.max(axis=axis, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=axis, keepdims=True)
    return x


def fit(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, seed: int = 1) -> Model:
    """Adam on the cross entropy of every position of ``CHUNK`` bytes at places drawn from the whole texts
    (not empty); classes count alike however many texts they have, and texts however long they are."""
    classes = sorted(set(labels))
    rng = np.random.default_rng(seed)
    scale = 1 / np.sqrt(hidden)
    weights = [
        rng.normal(0, 0.3, (3 * hidden, 256)), rng.normal(0, scale, (3 * hidden, hidden)),
        rng.normal(0, 0.3, (3 * hidden, 256)), rng.normal(0, scale, (3 * hidden, hidden)),
        rng.normal(0, scale, (len(classes), 2 * hidden)), np.zeros(len(classes)),
    ]
    weights = [w.astype(np.float32) for w in weights]
    model = Model(classes, Direction(*weights[0:2]), Direction(*weights[2:4]), weights[4], weights[5])
    y = np.array([classes.index(x) for x in labels])
    groups = [np.flatnonzero(y == k) for k in range(len(classes))]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts])
    start = np.cumsum(size) - size
    length = np.minimum(size, CHUNK)
    position = np.arange(CHUNK)[:, None]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(g, batch // len(classes) + 1) for g in groups])
        inside = position < length[pick]
        grid = start[pick] + rng.integers(0, size[pick] - length[pick] + 1) + position
        x, truth = np.where(inside, raw[np.minimum(grid, len(raw) - 1)], 0).astype(np.uint8), y[pick]
        n = len(pick)
        a, tape_a = model.forward.run(x, keep=True)
        b, tape_b = model.backward.run(x[::-1], keep=True)
        both = np.concatenate([a, b[::-1]], axis=1)  # T x 2H x N
        p = _softmax(np.matmul(model.output, both) + model.bias[:, None], axis=1)
        p[:, truth, np.arange(n)] -= 1
        mask = inside.astype(np.float32)
        p *= mask[:, None, :] / max(1.0, float(mask.sum()))
        d_output = np.einsum("tcn,thn->ch", p, both, optimize=True)
        d_both = np.matmul(model.output.T, p)
        grads = [
            *model.forward.back(x, tape_a, d_both[:, :hidden]),
            *model.backward.back(x[::-1], tape_b, d_both[::-1, hidden:]),
            d_output, p.sum(axis=(0, 2)),
        ]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * (0.1 + 0.9 * (1 - step / steps))
        for w, g, m, v in zip(weights, grads, first, second):
            g *= min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def train(documents: DataFrame, sample: int = SAMPLE, **settings) -> Model | None:
    """A model of the labelled documents outside the held-out fold; None if there are none.

    Every language gives up to ``sample`` / languages documents (``LEAST`` at least), whole: those with the
    smallest hashes of the id. A language is learned however rare it is, unless there are more than
    ``LANGUAGES``: then those of the most documents are (ties: the first names). What comes to the driver is
    bounded by these parameters and does not grow with the table."""
    ready(documents.sparkSession)
    rows = documents.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != "") & ~held_out(F.col("doc_id"))
    )
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return None
    each = max(LEAST, sample // len(counts))
    key = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 40))
    # the smallest hashes of each language, with a margin: only the texts of these are moved
    below = [(r["lang"], int(min(1.0, (1.5 * each + 50) / r["count"]) * (1 << 40))) for r in counts]
    below = documents.sparkSession.createDataFrame(below, "lang string, _below long")
    rows = rows.join(F.broadcast(below), "lang").withColumn("_key", key).where("_key < _below").select("_key", "lang", "text")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("_key", "text"))
    got = rows.withColumn("_nth", nth).where(F.col("_nth") <= each).orderBy("_key", "lang", "text").collect()
    return fit([r["text"].encode() for r in got], [r["lang"] for r in got], **settings) if got else None


def predict(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(class, probability) of every text of a column; class -1 and probability 0 without a letter."""
    raw, offsets = text_buffer(column)
    n = len(column)
    sizes = np.diff(offsets)
    lettered = np.diff(np.concatenate([[0], np.cumsum(_LETTER[raw])])[offsets]) > 0
    for i in np.flatnonzero(~lettered & (sizes > 0)):
        lettered[i] = any(c.isalpha() for c in raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    total = np.zeros((n, len(model.classes)))
    for part in _chunks(offsets, lettered):
        row, at, size = part
        grid = at[None, :] + np.arange(CHUNK)[:, None]
        inside = np.arange(CHUNK)[:, None] < size[None, :]
        data = np.where(inside, raw[np.minimum(grid, len(raw) - 1)], 0).astype(np.uint8)
        p = _softmax(model.logits(data), axis=1) * inside[:, None, :]
        for k in range(len(model.classes)):
            total[:, k] += np.bincount(row, p[:, k].sum(axis=0), minlength=n)
    probs = total / np.maximum(sizes, 1)[:, None]
    best = probs.argmax(axis=1)
    score = np.clip(probs[np.arange(n), best], 0.0, 1.0)
    return np.where(lettered, best, -1), np.where(lettered, score, 0.0)


def _chunks(offsets: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, start, length) of the chunks of all wanted texts, a bounded number at a time."""
    sizes = np.where(wanted, np.diff(offsets), 0)
    counts = -(-sizes // CHUNK)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    step = BYTES_AT_ONCE // CHUNK
    for a in range(0, total, step):
        index = np.arange(a, min(a + step, total))
        row = np.searchsorted(ends, index, side="right")
        inner = (index - (ends[row] - counts[row])) * CHUNK
        yield row, offsets[row] + inner, np.minimum(sizes[row] - inner, CHUNK)


def label(documents: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``documents`` plus ``held_out``, ``lang_pred`` and ``score`` (replacing such columns).

    Null texts and texts without a letter get ``und`` and score 0, as does every text if there was nothing
    to learn from. A null id counts as held out. Rows that repeat are labelled one by one; an empty table
    gives an empty result."""
    spark = documents.sparkSession
    ready(spark)
    base = documents.drop("held_out", "lang_pred", "score")
    out = base.withColumn("held_out", held_out(F.col("doc_id")))
    if model is None:
        return out.withColumn("lang_pred", F.lit("und")).withColumn("score", F.lit(0.0))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields]
    schema = ", ".join([*kinds, "lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            best, score = predict(batch.column("text"), model)
            names = np.array([*model.classes, "und"], dtype=object)[best]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(score)], names=[*batch.schema.names, "lang_pred", "score"]
            )

    return out.mapInArrow(run, schema)
