"""Best-fit packing with certified bin counts.

Documents are cut into pieces of at most ``capacity`` tokens. Pieces are dealt over partitions, each of
which packs its own by best-fit decreasing. Lower bounds from dual-feasible functions certify the bin
count of a partition: where count and bound meet, no packing of those pieces is better. Partitions with a
gap give the pieces of their bins with free room to an exchange, which deals them anew over fewer
partitions and packs again.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.llm.common import content_key, cut, ready, slices
from wharf.llm.tokens import TokenIds

CAPACITY = 4096
END_ID = 1  # follows every document's ids
PARTITION_TOKENS = 1 << 24  # tokens that one task packs, about (4,096 full sequences)

PIECE = "doc_id {id}, _hash long, piece int, start long, length long, ids_crc32 long"


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: ``doc_id, _hash, piece, start, length, ids_crc32`` (and ``ids``).

    Only documents longer than ``capacity`` are cut. Null text counts as empty: one piece that holds the
    end id alone. Repeated rows give repeated pieces; an empty table gives no piece."""
    ready(documents.sparkSession)
    schema = PIECE.format(id=dict(documents.dtypes)["doc_id"]) + (", ids array<int>" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TokenIds.of(tokenizer)
        for batch in slices(batches, "text"):
            row, found = [], []
            for i, text in enumerate(batch.column("text")):
                ids = np.append(tokens.ids(text.as_py()), np.uint32(END_ID)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    row.append(i)
                    found.append((k, at, len(part), zlib.crc32(part.tobytes()), *([part.astype(np.int32)] if with_ids else [])))
            columns = [batch.column("doc_id").take(pa.array(row)), batch.column("_hash").take(pa.array(row))]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns += [pa.array(list(c), k) for c, k in zip(zip(*found), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents.select("doc_id", content_key("doc_id", "text").alias("_hash"), "text").mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of items taken in the order given: each goes to the fullest bin that has room."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free room
    open_rooms = 0  # bit r: a bin with free room r exists
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    count = 0
    for i, size in enumerate(lengths.tolist()):
        fitting = open_rooms >> size
        if fitting:
            r = size + (fitting & -fitting).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms ^= 1 << r
        else:
            r, b = capacity, count
            count += 1
        bins[i], offsets[i] = b, capacity - r
        left = r - size
        if left:
            if not room[left]:
                open_rooms |= 1 << left
            room[left].append(b)
    return bins, offsets


def bin_bound(lengths: np.ndarray, capacity: int) -> int:
    """A proven lower bound on the bins, the best of several dual-feasible functions.

    Such a function sends sizes that fit into one bin to weights of at most 1 together, so the weights of
    all items, rounded up, bound the bins from below. Used: the size itself; stretched rounding down to
    multiples of 1/k (multiples of 1/(k+1) stay); and for each t up to half, 1 above 1 - t and 0 below t."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    for k in range(1, 41):
        exact = size * (k + 1) % capacity == 0
        weight = np.where(exact, size * k, size * (k + 1) // capacity * capacity)  # times capacity * k
        best = max(best, -(-int((count * weight).sum()) // (capacity * k)))
    large = np.cumsum(count[::-1])[::-1]  # items of at least a size
    filled = np.concatenate([[0], np.cumsum(count * size)])
    t = np.arange(1, capacity // 2 + 1)
    ones = np.where(capacity - t + 1 <= capacity, large[np.minimum(capacity - t + 1, capacity)], 0)
    middle = filled[capacity - t + 1] - filled[t]
    return max(best, int((ones + -(-middle // capacity)).max()))


def _pack(capacity: int, base: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_hash", "piece", "start"], ascending=[False, True, True, True], kind="stable")
        lengths = rows["length"].to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        total = int(bins.max()) + 1
        bound = bin_bound(lengths, capacity)
        slack = capacity - np.bincount(bins, lengths, minlength=total).astype(np.int64)
        rows["sequence_id"] = base + (int(key[0]) << 28) + bins
        rows["offset"] = offsets
        rows["partition_bins"], rows["partition_bound"] = total, bound
        rows["_open"] = (slack[bins] > 0) & (total > bound)
        return rows.drop(columns="_group")

    return run


def pack(found: DataFrame, capacity: int = CAPACITY, partition_tokens: int = PARTITION_TOKENS) -> DataFrame:
    """Adds ``sequence_id``, ``offset``, ``partition_bins`` and ``partition_bound`` to pieces.

    ``found`` has ``doc_id, _hash, piece, start, length`` (and more) with lengths from 1 to ``capacity``.
    Every task packs about ``partition_tokens`` tokens, in every round. A sequence's offsets are gapless
    from 0. Exchanges go on as long as one wins bins; ``partition_bins`` and ``partition_bound`` say how large
    a gap remains. An empty input gives an empty result; repeated pieces are packed one by one.
    """
    ready(found.sparkSession)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields]
    schema = ", ".join([*kinds, "sequence_id long", "offset long", "partition_bins long", "partition_bound long", "_open boolean"])
    open_rows, settled, names = cut(found), None, found.columns
    before = None
    for n in itertools.count():
        tokens = open_rows.agg(F.sum("length")).first()[0] or 0
        if settled is not None and not tokens:
            break
        groups = max(1, -(-tokens // partition_tokens))
        # a round deals by another hash than the one before, so pieces meet new neighbours
        group = F.pmod(F.xxhash64(F.lit(n), "doc_id", "_hash", "piece"), F.lit(groups))
        packed = open_rows.select(*names, group.alias("_group")).groupBy("_group").applyInPandas(_pack(capacity, n << 56), schema)
        packed = cut(packed)
        if before is not None:
            bins = packed.select("sequence_id").distinct().count()
            if bins >= before:  # nothing won: the packing of the round before stays
                break
        done = packed.where(~F.col("_open"))
        settled = done if settled is None else settled.unionByName(done)
        last = packed.where("_open")
        before = last.select("sequence_id").distinct().count()
        if groups == 1 or not before:
            break
        open_rows = last
    return settled.unionByName(last).drop("_open")
