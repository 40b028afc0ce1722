"""Shared helpers of the training-data operators: row keys, lineage cuts, and numpy text passes.

The numpy passes work on a whole Arrow batch at once: the batch's texts lie back to back in one byte
buffer, so words, hashes and windows of all its rows are found with a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wharf.session import ensure_checkpoint_dir, ship_package

# ASCII white space that parts words: the complement of [^\x20\x09-\x0D].
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 256 << 10  # texts handled together in one numpy pass
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000}  # rows that Spark sends to Python at once

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def ready(spark: SparkSession) -> None:
    """Ship the package to the executors, make sure that a shared checkpoint folder is set, and keep the
    Arrow batches between Spark and Python small: with long texts, Spark's 10,000 rows a batch are held
    several times over in each task. A smaller setting of the session stays as it is."""
    ship_package(spark)
    for name, most in ARROW_BATCH.items():
        have = int(spark.conf.get(name))
        if have <= 0 or have > most:
            spark.conf.set(name, str(most))
    folder = ensure_checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the cluster's shared checkpoint folder (survives lost executors)."""
    ready(df.sparkSession)
    return df.checkpoint(eager=True)


def content_key(*cols: str) -> Column:
    """64-bit hash of a row's columns. Used with the id itself, as ids may repeat or be null."""
    return F.xxhash64(*[F.col(c) for c in cols])


def boxed(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of all columns but the text) and ``text``: the names of other columns then clash
    with none that an operator adds on its way. :func:`unboxed` gives the columns back."""
    rest = [c for c in (columns or df.columns) if c != "text"]
    return df.select(F.struct(*[F.col(c) for c in rest]).alias("row"), "text")


def unboxed(columns: list[str], text: str = "text") -> list[Column]:
    return [F.col(text).alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns]


# ------------------------------------------------------------------ Arrow batches as byte buffers


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds at most about ``limit`` bytes in each (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffer(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty; offsets start at 0."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offs, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words never cross rows."""
    n = len(raw)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    solid = ~_SPACE[raw]
    first = np.zeros(n + 1, bool)
    first[offsets] = True  # a row's first byte; marks at n are harmless
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


# ------------------------------------------------------------------ 64-bit hashes

_R = np.random.Generator(np.random.PCG64(20240611))
_BYTE_VALUE = _R.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 2 * BATCH_BYTES:  # one very long text does not stay in memory
            _POWERS[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RollingHash:
    """Hashes of arbitrary spans of a byte buffer from one prefix sum (polynomial modulo 2**64)."""

    def __init__(self, raw: np.ndarray, fold: bool = False) -> None:
        values = _BYTE_VALUE[LOWER[raw]] if fold else _BYTE_VALUE[raw]
        n = len(raw)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _powers(_BASE, n), out=self.sums[1:])
        self.n = n

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        inverse = _powers(_INVERSE, self.n + 1)
        h = (self.sums[ends] - self.sums[starts]) * inverse[starts]
        return mix(h ^ mix((ends - starts).astype(np.uint64)))


def window_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Order-sensitive hash of every run of ``k`` consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mix(out + words[i : i + n] * np.uint64(2 * i + 3))
    return out


def per_row_unique(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs, sorted by row then value."""
    order = np.lexsort((values, rows))
    r, v = rows[order], values[order]
    keep = np.ones(len(r), bool)
    keep[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return r[keep], v[keep]
