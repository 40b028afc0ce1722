"""Nearest neighbours by a block matrix join.

Queries and candidates are packed into blocks; every tile (a group of query blocks against a group of
candidate blocks) is one task. A tile multiplies int8 vectors, which gives every inner product up to a
bound that the quantisation errors prove. Pairs that cannot be among a query's best by that bound are
done; the others are recomputed from the original vectors in double precision and kept in a heap per
query. A last merge takes each query's best over its tiles. The result is exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharf.llm.common import cut, ready

BLOCK_ROWS = 2048
QUERY_GROUP, CANDIDATE_GROUP = 8192, 32768  # vectors of a tile's sides, about
PART = (256, 4096)  # pairs that are multiplied at once


def _blocks(vectors: DataFrame) -> DataFrame:
    """Blocks of usable vectors: dim, n, ids, data (bytes of long ids and double vectors)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, tuple[list, list]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, rows = have.pop(dim)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([np.array(rows).tobytes()], pa.binary())],
                names=["dim", "n", "ids", "data"],
            )

        for batch in batches:
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
                if i is None or not v.is_valid or not len(v.values) or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all() or not x.any():
                    continue
                ids, rows = have.setdefault(len(x), ([], []))
                ids.append(i)
                rows.append(x)
                if len(ids) >= BLOCK_ROWS:
                    yield block(len(x))
        for dim in list(have):
            yield block(dim)

    return vectors.select("vec_id", "embedding").mapInArrow(run, "dim int, n int, ids binary, data binary")


PAIRS = 1 << 16  # pairs recomputed in double together


class Quantised:
    """Vectors as int8 with one scale each, and the norms that bound the error of products."""

    def __init__(self, x: np.ndarray) -> None:
        self.scale = np.abs(x).max(axis=1) / 127
        safe = np.where(self.scale > 0, self.scale, 1.0)
        self.whole = np.clip(np.rint(x / safe[:, None]), -127, 127).astype(np.int8)
        near = self.whole * safe[:, None]
        self.error = np.linalg.norm(x - near, axis=1)
        self.near = np.linalg.norm(near, axis=1)
        self.norm = np.linalg.norm(x, axis=1)
        self.scale = safe


def best_of_tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
    """Per query, its k best (score, vec_id) of the candidates, leaving out its own id."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in q_ids]  # smallest first: (score, -vec_id)
    qq = Quantised(q)
    for b in range(0, len(c_ids), PART[1]):
        part, ids = c[b : b + PART[1]], c_ids[b : b + PART[1]]
        cc = Quantised(part)
        # int8 products sum to less than 2**24 for up to 1040 components, so float32 holds them exactly;
        # beyond, float64 does
        kind = np.float32 if q.shape[1] <= 1040 else np.float64
        right = cc.whole.astype(kind).T
        for a in range(0, len(q_ids), PART[0]):
            rows = slice(a, a + PART[0])
            near = (qq.whole[rows].astype(kind) @ right) * (qq.scale[rows, None] * cc.scale[None, :])
            bound = qq.error[rows, None] * cc.near[None, :] + qq.norm[rows, None] * cc.error[None, :]
            bound += 1e-9 * qq.norm[rows, None] * cc.norm[None, :]  # rounding of the doubles themselves
            own = q_ids[rows, None] == ids[None, :]
            low = np.where(own, -np.inf, near - bound)
            least = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(low), -np.inf)
            floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[rows]])
            alive = (near + bound >= np.maximum(least, floor)[:, None]) & ~own
            i, j = np.nonzero(alive)
            pairs = [slice(p, p + PAIRS) for p in range(0, len(i), PAIRS)]
            score = np.concatenate([np.einsum("ij,ij->i", q[rows][i[p]], part[j[p]]) for p in pairs] or [np.zeros(0)])
            # equal vectors all survive the bound: of each query's pairs the k best, ties to smaller ids, go on
            order = np.lexsort((ids[j], -score, i))
            order = order[np.arange(len(i)) - np.searchsorted(i, i[order]) < k]
            i, j, score = i[order], j[order], score[order]
            for x, y, s in zip(i.tolist(), ids[j].tolist(), score.tolist()):
                heap = heaps[a + x]
                if len(heap) < k:
                    heapq.heappush(heap, (s, -y))
                elif (s, -y) > heap[0]:
                    heapq.heapreplace(heap, (s, -y))
    return [[(s, -y) for s, y in sorted(h, reverse=True)] for h in heaps]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest by inner product, ties to smaller ids.

    ``vectors``: ``vec_id`` long, ``embedding`` array of numbers. Vectors that are null, empty, zero or
    hold null or non-finite components, and rows without an id, take no part. Only vectors of equal length
    meet. Rows with the query's id count as its own and are no candidates. A query row that repeats is
    searched once; a candidate row that repeats is found as often as it is there. With fewer candidates than
    ``k``, all are returned. An empty table gives an empty result.

    A tile holds some 8192 queries and 32768 candidates, whatever the table's size: queries are sent to
    every candidate group and candidates to every query group, as blocks.
    """
    ready(vectors.sparkSession)
    asked = vectors.where(is_query & F.col("vec_id").isNotNull()).select("vec_id", "embedding").dropDuplicates(["vec_id", "embedding"])
    queries, candidates = cut(_blocks(asked)), cut(_blocks(vectors))
    size = lambda blocks: blocks.agg(F.sum("n")).first()[0] or 0
    nq, nc = max(1, -(-size(queries) // QUERY_GROUP)), max(1, -(-size(candidates) // CANDIDATE_GROUP))
    spread = lambda blocks, groups: F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("gq", spread(queries, nq)).withColumn("gc", every(nc))
    right = candidates.withColumn("gc", spread(candidates, nc)).withColumn("gq", every(nq))

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        for dim in sorted(set(a["dim"]) & set(b["dim"])):
            x, y = a[a["dim"] == dim], b[b["dim"] == dim]
            ids = [np.concatenate([np.frombuffer(i, np.int64) for i in t["ids"]]) for t in (x, y)]
            data = [np.concatenate([np.frombuffer(d).reshape(-1, dim) for d in t["data"]]) for t in (x, y)]
            for i, found in zip(ids[0].tolist(), best_of_tile(ids[0], data[0], ids[1], data[1], k)):
                out += [(i, v, s) for s, v in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    tiles = left.groupBy("dim", "gq", "gc").cogroup(right.groupBy("dim", "gq", "gc")).applyInPandas(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return tiles.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
