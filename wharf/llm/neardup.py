"""MinHash near-dedup: an inverted join over signature coordinates, confirmed on full shingle sets.

Texts with equal shingle sets form one class; all that follows works on classes. A class is posted under
each (coordinate, value) of its signature. Two classes count as candidates if their signatures collide in
at least ``need`` coordinates. Of a class's postings only the ``H - need + 1`` rarest are merged (the
prefix): two classes that collide often enough must share one of them; the frequent lists are skipped and
only probed through the signatures. Pairs from short lists are joined, their collisions counted, and the
survivors confirmed on the full sets. Long lists (families of very many near copies) are compared block by
block inside tasks, which give back a spanning forest of the confirmed links and never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharf.llm.common import RollingHash, boxed, content_key, cut, ready, slices, text_buffer, unboxed, window_hash, word_spans
from wharf.llm.components import components

COORDINATES = 40
SHORT = 12  # classes of a list whose pairs are joined; longer lists go to the block comparison
BLOCK = 512  # classes on each side of a block
ROWS_AT_ONCE = 1 << 13

_R = np.random.Generator(np.random.PCG64(99))
_MUL = _R.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_ADD = _R.integers(0, 2**63, 64, dtype=np.uint64)
_ROW_BITS = np.uint64(50)  # shingles keep 50 bits of their hash


def least_collisions(similarity: float, coordinates: int = COORDINATES) -> int:
    """Collisions that a pair at the threshold falls short of less than once in 100,000 times."""
    from math import comb

    below, n = 0.0, 0
    while n <= coordinates:
        below += comb(coordinates, n) * similarity**n * (1 - similarity) ** (coordinates - n)
        if below > 1e-5:
            return max(n, 1)
        n += 1
    return coordinates


def shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text of a column (A-Z lowered): (row starts into values, values).

    A shingle is ``k`` consecutive words; a text with fewer words has its whole sequence as one; a text
    without words has none. Values of a row are sorted."""
    raw, offsets = text_buffer(column)
    n = len(column)
    starts, ends, rows = word_spans(raw, offsets)
    words = RollingHash(raw, fold=True).spans(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    count = np.bincount(rows, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)[:-1]]) if n else np.zeros(0, np.int64)
    row_parts, value_parts = [], []
    for j in range(1, k + 1):
        hashes = window_hash(words, j)
        if j < k:
            which = np.flatnonzero(count == j)
            at = first[which]
        else:
            at = np.flatnonzero(rows[: max(0, len(rows) - k + 1)] == rows[k - 1 :]) if len(rows) >= k else np.zeros(0, np.int64)
            which = rows[at]
        row_parts.append(which)
        value_parts.append(hashes[at] + np.uint64(j))
    row, value = np.concatenate(row_parts), np.concatenate(value_parts)
    key = np.sort((row.astype(np.uint64) << _ROW_BITS) | (value >> (np.uint64(64) - _ROW_BITS)))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    bounds = np.searchsorted(key >> _ROW_BITS, np.arange(n + 1, dtype=np.uint64))
    return bounds, key & ((np.uint64(1) << _ROW_BITS) - np.uint64(1))


def signature(bounds: np.ndarray, values: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """int32 matrix (rows x coordinates); rows without shingles hold zeros."""
    n = len(bounds) - 1
    out = np.zeros((n, coordinates), np.uint32)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        spread = values << np.uint64(64 - int(_ROW_BITS))
        spread ^= spread >> np.uint64(31)
        for j in range(coordinates):
            h = spread * _MUL[j]
            h += _ADD[j]
            h >>= np.uint64(32)
            out[full, j] = np.minimum.reduceat(h.astype(np.uint32), bounds[full])
    return out.view(np.int32)


def _digests(bounds: np.ndarray, values: np.ndarray) -> np.ndarray:
    from wharf.llm.common import mix

    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values + np.uint64(0x5851F42D4C957F2D)))])
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + (bounds[1:] - bounds[:-1]).astype(np.uint64)).view(np.int64)


def _rows(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, column):
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _signed(documents: DataFrame, k: int) -> DataFrame:
    """doc_id, _hash, n, cls (64-bit digest of the set), sig."""
    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, _hash long, n long, cls long, sig array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _rows(batches, "text"):
            bounds, values = shingles(batch.column("text"), k)
            sig = signature(bounds, values)
            flat = pa.ListArray.from_arrays(np.arange(0, sig.size + 1, COORDINATES, dtype=np.int32), pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_hash"), pa.array(np.diff(bounds)), pa.array(_digests(bounds, values)), flat],
                names=["doc_id", "_hash", "n", "cls", "sig"],
            )

    return documents.select("doc_id", content_key("doc_id", "text").alias("_hash"), "text").mapInArrow(run, schema)


def _sets(documents: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """cls, n, sig, set (sorted shingles as bytes) of the wanted classes (cls, rep)."""
    texts = documents.select("doc_id", content_key("doc_id", "text").alias("_hash"), "text")
    wanted = wanted.select("cls", F.col("rep.id").alias("_i"), F.col("rep.hash").alias("_h"))
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h"))).select("cls", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _rows(batches, "text"):
            bounds, values = shingles(batch.column("text"), k)
            sig = signature(bounds, values)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("cls"), pa.array(np.diff(bounds)), pa.array([s.tobytes() for s in sig], pa.binary()),
                    pa.array([values[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                ],
                names=["cls", "n", "sig", "set"],
            )

    # rows that repeat give the same class more than once
    return texts.mapInArrow(run, "cls long, n long, sig binary, set binary").dropDuplicates(["cls"])


def _linked(common: Column | np.ndarray, a, b, percent: int):
    return 100 * common >= percent * (a + b - common)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    right = sets.select(F.col("cls").alias("b"), F.col("set").alias("sb"))
    left = sets.select(F.col("cls").alias("a"), F.col("set").alias("sa"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(bool(_linked(common, len(x), len(y), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _block_links(left: pd.DataFrame, right: pd.DataFrame, percent: int, need: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks of classes (cls, label, n, sig, set), leaving out
    pairs with the same label (known to hang together)."""
    sig = [np.stack([np.frombuffer(s, np.int32) for s in x["sig"]]) for x in (left, right)]
    n = [x["n"].to_numpy() for x in (left, right)]
    hits = np.zeros((len(left), len(right)), np.uint8)
    for j in range(sig[0].shape[1]):
        hits += sig[0][:, j, None] == sig[1][None, :, j]
    ok = (hits >= need) & (left["label"].to_numpy()[:, None] != right["label"].to_numpy()[None, :])
    small, large = np.minimum(n[0][:, None], n[1][None, :]), np.maximum(n[0][:, None], n[1][None, :])
    ok &= 100 * small >= percent * large
    rows, cols = np.flatnonzero(ok.any(axis=1)), np.flatnonzero(ok.any(axis=0))
    if not len(rows):
        return []
    # intersections of all sets at once: products of incidence matrices, a slice of the shingles at a time
    a = [np.frombuffer(left["set"].iloc[i], np.uint64) for i in rows]
    b = [np.frombuffer(right["set"].iloc[i], np.uint64) for i in cols]
    shared = np.intersect1d(np.unique(np.concatenate(a)), np.unique(np.concatenate(b)))
    common = np.zeros((len(rows), len(cols)), np.float32)

    def cells(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        r = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        v = np.concatenate(parts)
        at = np.searchsorted(shared, v)
        at[at == len(shared)] = 0
        found = shared[at] == v if len(shared) else np.zeros(len(v), bool)
        order = np.argsort(at[found], kind="stable")
        return r[found][order], at[found][order]

    (ra, ca), (rb, cb) = cells(a), cells(b)
    step = 8192
    for c in range(0, len(shared), step):
        x = np.zeros((len(rows), step), np.float32)
        y = np.zeros((len(cols), step), np.float32)
        lo, hi = np.searchsorted(ca, [c, c + step])
        x[ra[lo:hi], ca[lo:hi] - c] = 1
        lo, hi = np.searchsorted(cb, [c, c + step])
        y[rb[lo:hi], cb[lo:hi] - c] = 1
        common += x @ y.T
    link = _linked(common.astype(np.int64), n[0][rows][:, None], n[1][cols][None, :], percent) & ok[np.ix_(rows, cols)]
    ids = [left["cls"].to_numpy()[rows].tolist(), right["cls"].to_numpy()[cols].tolist()]
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(link))):
        u, v = ids[0][i], ids[1][j]
        p, q = find(u), find(v)
        if p != q:
            parent[p] = q
            forest.append((u, v))
    return forest


def _long_list_links(posts: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, need: int) -> DataFrame:
    """Links within long lists (tok, size, cls): members are dealt over blocks, and every pair of blocks is
    a task of its own, so no list is ever in one task."""
    posts = posts.join(labels, "cls", "left").select("tok", "size", "cls", F.coalesce("label", "cls").alias("label"))
    mixed = posts.groupBy("tok").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("tok")
    posts = posts.join(mixed, "tok")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cls"), blocks).cast("int")
    posts = posts.withColumn("own", own).select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    posts = posts.select("tok", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "label")
    rows = posts.join(sets, "cls")

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        i, j = int(key[1]), int(key[2])
        found = []
        # a block can be larger than BLOCK by chance; parts keep the matrices small
        left, right = group[group["own"] == i], group[group["own"] == j]
        for x in range(0, len(left), BLOCK):
            for y in range(0, len(right), BLOCK):
                if i != j or x <= y:
                    found += _block_links(left.iloc[x : x + BLOCK], right.iloc[y : y + BLOCK], percent, need)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy("tok", "i", "j").applyInPandas(run, "a long, b long")


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, _hash, n_shingles, component_id, kept``.

    Documents are linked if ``100 * intersection >= percent * union`` of their sets of distinct ``k``-word
    shingles (A-Z lowered, ASCII white space parts words). ``component_id`` is the smallest doc_id that
    links reach, itself included; ``kept`` marks documents whose doc_id it is.

    Null and empty texts, and texts without words, have no shingle and are linked with nothing. Rows that
    repeat have equal sets and so one component. A null id takes part; it names a component only if all of
    its ids are null, and is kept only there. An empty table gives an empty result. Other columns do not matter.

    Candidates rest on signatures: a pair at the threshold is missed less than once in 100,000. A class is
    named by a 64-bit digest of its set.
    """
    spark = documents.sparkSession
    ready(spark)
    need = least_collisions(percent / 100)
    prefix = COORDINATES - need + 1
    signed = cut(_signed(documents, k))
    rep = F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"), F.col("_hash").alias("hash"))
    classes = cut(
        signed.where("n > 0").groupBy("cls").agg(F.min(rep).alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("docs"))
    )

    # postings; lists of one class make no pair, but stand first in the order of the prefix
    tokens = classes.select("cls", F.posexplode("sig").alias("pos", "value")).select("cls", (F.col("value").cast("long") * 64 + F.col("pos")).alias("tok"))
    shared = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    lists = tokens.join(shared, "tok").groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("df", "tok"))).alias("own"))
    left = F.lit(prefix - COORDINATES) + F.size("own")
    posts = lists.where(left > 0).select("cls", F.explode(F.slice("own", F.lit(1), left)).alias("p")).select("cls", F.col("p.tok").alias("tok"))
    sizes = posts.groupBy("tok").agg(F.count(F.lit(1)).alias("size"), F.min("cls").alias("lead")).where("size > 1")
    posts = cut(posts.join(sizes, "tok"))

    # candidate pairs: all of a short list, and every member of a long one with its first
    short = posts.where(F.col("size") <= SHORT)
    pairs = short.select("tok", F.col("cls").alias("a")).join(short.select("tok", F.col("cls").alias("b")), "tok").where("a < b").select("a", "b")
    leads = posts.where((F.col("size") > SHORT) & (F.col("cls") != F.col("lead"))).select(F.col("lead").alias("a"), F.col("cls").alias("b"))
    pairs = pairs.unionByName(leads).distinct()
    one = classes.select("cls", "n", "sig")
    pairs = pairs.join(one.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sig").alias("siga")), "a")
    pairs = pairs.join(one.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sigb")), "b")
    collisions = F.size(F.filter(F.zip_with("siga", "sigb", lambda x, y: x == y), lambda same: same))
    near = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    pairs = cut(pairs.where(near & (collisions >= need)).select("a", "b"))

    long_posts = posts.where(F.col("size") > SHORT).select("tok", "size", "cls")
    wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).unionByName(long_posts.select("cls")).distinct()
    sets = cut(_sets(documents, classes.select("cls", "rep").join(wanted, "cls"), k))
    links = cut(_confirm(pairs, sets, percent))
    # what the links say so far, one step deep, spares the comparison of members that hang together
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = ends.groupBy(F.col("a").alias("cls")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    links = links.unionByName(_long_list_links(long_posts, sets, labels, percent, need))

    roots = cut(components(links))
    named = classes.join(roots.withColumnRenamed("node", "cls"), "cls").groupBy("root").agg(F.min("rep").alias("rep"))
    named = roots.join(named, "root").select(F.col("node").alias("cls"), "rep")
    alone = classes.join(roots, F.col("cls") == F.col("node"), "left_anti").where("docs > 1").select("cls", "rep")
    named = named.unionByName(alone).select(F.col("cls").alias("_c"), F.col("rep").alias("_rep"))
    out = signed.select("doc_id", "_hash", "n", "cls").join(named, (F.col("cls") == F.col("_c")) & (F.col("n") > 0), "left")
    component = F.when(F.col("_rep").isNotNull(), F.col("_rep.id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "_hash", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id").eqNullSafe(component), F.lit(False)).alias("kept"),
        F.when(F.col("_rep").isNull(), F.lit(True)).otherwise(F.col("_hash") == F.col("_rep.hash")).alias("_first"),
    )


def keep_one(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near duplicates: of each component, the row with the smallest doc_id (then
    the smallest hash of id and text) stays; equal rows are kept once. Documents without words all stay."""
    found = near_duplicates(documents, k, percent).where("kept AND _first")
    found = found.select(F.col("doc_id").alias("_i"), F.col("_hash").alias("_h"), "n_shingles").distinct()
    cols = documents.columns
    nth = Window.partitionBy("_id", "_key").orderBy(F.lit(0))
    rows = boxed(documents).withColumn("_id", F.col("row.doc_id")).withColumn("_key", F.xxhash64("_id", "text"))
    rows = rows.join(found, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_h")))
    return rows.withColumn("_nth", F.row_number().over(nth)).where((F.col("_nth") == 1) | (F.col("n_shingles") == 0)).select(*unboxed(cols))
