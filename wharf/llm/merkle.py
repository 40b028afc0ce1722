"""A content-addressed manifest of a dataset: a digest per row, a tree per group, a tree over the groups.

Rows are leaves. The leaves of a group, in order, are hashed in runs of ``FAN``, level by level, up to the
group's subroot; the subroots, in order, likewise up to the root. What is stored are records from a digest
to its children's digests, bundled in blocks of ``LEVELS`` levels (at most ``FAN ** LEVELS`` leaves), each
named by the digest at its top.

A proof comes from descending the records: a request starts at the root's digest, takes at each level the
child that the leaf's rank names by its next digit, and collects the children not taken; reversed, the
segments of the way are the proof from the leaf upwards. Requests for leaves of one block share their way
down to it, so a block is fetched once whatever the number of its leaves, and no step is a join of every
leaf with the root.

Ranks come from one sort by range: a hot group lies over many tasks, and equal rows are parted by their
place. No task holds more than one block's leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharf.llm.common import cut, ready

FAN = 3
LEVELS = 5
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

RECORDS = "array<struct<digest: binary, children: array<binary>>>"
BLOCKS = f"g string, idx long, n long, block binary, records {RECORDS}"


def row_digest(*values: Column) -> Column:
    """sha256 of a row's values as 32 bytes: ``-`` for null, else byte count, ``:`` and the value as text."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def joined_digest(digests: list[str]) -> str:
    """The digest over digests, which count as lower-case hex text."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank`` (from 0) and ``n``: a row's place and the number of rows in its group ``g``.

    ``order`` sorts a group's rows; equal ones are taken in any order. Rows are dealt by range over
    (group, order, place), so neither a hot group nor many equal rows make one task; what is summed over
    the parts of a group has one row per group and part."""
    rows = cut(rows).withColumn("_place", F.monotonically_increasing_id())
    keys = ["g", *order, "_place"]
    rows = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_place"))
    rows = rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    parts = rows.groupBy("g", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("g")
    before = F.sum("_n").over(whole.orderBy("_part")) - F.col("_n")
    parts = parts.select("g", "_part", "_first", before.alias("_before"), F.sum("_n").over(whole).alias("n"))
    found = rows.join(parts, ["g", "_part"])
    return found.withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before")


def _grown(digests: list[str], rounds: int) -> tuple[str, list[tuple[str, list[str]]]]:
    """The top of ``rounds`` levels over a block's digests, and the records of the levels."""
    records = []
    for _ in range(rounds):
        runs = [digests[i : i + FAN] for i in range(0, len(digests), FAN)]
        digests = [joined_digest(run) for run in runs]
        records += zip(digests, runs)
    return digests[0], records


def _rounds(n: int) -> int:
    """Levels of a block in a group of ``n`` nodes: all, or as many as lead to one node."""
    rounds = 0
    while n > 1 and rounds < LEVELS:
        n, rounds = -(-n // FAN), rounds + 1
    return rounds


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grouped nodes -> blocks: the digest at the top and the records below it."""
    kind = pa.list_(pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))]))
    for batch in batches:
        tops, records = [], []
        for n, digests in zip(batch.column("n").to_pylist(), batch.column("digests").to_pylist()):
            top, found = _grown([d.hex() for d in digests], _rounds(n))
            tops.append(bytes.fromhex(top))
            records.append([(bytes.fromhex(d), [bytes.fromhex(c) for c in run]) for d, run in found])
        columns = [batch.column("g"), batch.column("idx"), batch.column("n")]
        rest = [c for c in batch.schema.names if c not in ("g", "idx", "n", "digests")]
        columns += [pa.array(tops, pa.binary()), pa.array(records, kind), *[batch.column(c) for c in rest]]
        yield pa.RecordBatch.from_arrays(columns, names=["g", "idx", "n", "block", "records", *rest])


def grow(leaves: DataFrame, payload: list[str]) -> list[DataFrame]:
    """The store of the trees over ``g, rank, n, digest`` (and ``payload``) rows: per stage of ``LEVELS``
    levels a table ``g, idx, n, block, records``; the first also has ``leaves``, the payload in rank order.

    A stage's blocks are the next stage's nodes, where a group has more than one. An empty input gives one
    empty stage. The number of stages grows with the logarithm of the largest group."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, stages = leaves.withColumn("leaf", F.struct("rank", *payload)), []
    while True:
        first = not stages
        kind = dict(nodes.dtypes).get("leaf")
        held = F.struct("rank", "digest", *(["leaf"] if first else []))
        grouped = nodes.groupBy("g", F.expr(f"rank div {BLOCK}").alias("idx")).agg(
            F.first("n").alias("n"), F.array_sort(F.collect_list(held)).alias("_nodes")
        )
        rows = grouped.select("g", "idx", "n", F.col("_nodes.digest").alias("digests"), *([F.col("_nodes.leaf").alias("leaves")] if first else []))
        blocks = cut(rows.mapInArrow(_build, BLOCKS + (f", leaves array<{kind}>" if first else "")))
        stages.append(blocks)
        if most <= BLOCK:
            return stages
        most = -(-most // BLOCK)
        nodes = blocks.where(F.col("n") > BLOCK).select(
            "g", F.col("idx").alias("rank"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("digest")
        )


# A way down is kept as bytes, a level after the other: the digit taken, the number of children, and the
# children not taken.


def _segment(store: dict[bytes, list[bytes]], top: bytes, rounds: int, at: int) -> tuple[bytes, bytes]:
    """(the way from ``top`` to the node ``at`` of its block, that node's digest)."""
    way, digest = [], top
    for level in reversed(range(rounds)):
        children = store[digest]
        digit = at // FAN**level % FAN
        way.append(bytes((digit, len(children))) + b"".join(children[:digit] + children[digit + 1 :]))
        digest = children[digit]
    return b"".join(way), digest


def proof_steps(way: bytes) -> list[tuple[list[str], list[str]]]:
    """A way down, reversed: per level, from the leaf upwards, the digests left and right of one's own."""
    steps, i = [], 0
    while i < len(way):
        digit, count = way[i], way[i + 1]
        others = [way[j : j + 32].hex() for j in range(i + 2, i + 2 + 32 * (count - 1), 32)]
        steps.append((others[:digit], others[digit:]))
        i += 2 + 32 * (count - 1)
    return steps[::-1]


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Requests that stand at blocks -> requests for each of the blocks' nodes, a level of blocks deeper."""
    for batch in batches:
        taken, ways, digests, ranks = [], [], [], []
        columns = [batch.column(c).to_pylist() for c in ("idx", "n", "block", "records", "way")]
        for i, (idx, n, block, records, way) in enumerate(zip(*columns)):
            store = {r["digest"]: r["children"] for r in records}
            for at in range(min(BLOCK, n - idx * BLOCK)):
                segment, digest = _segment(store, block, _rounds(n), at)
                taken.append(i)
                ways.append(way + segment)
                digests.append(digest)
                ranks.append(idx * BLOCK + at)
        same = [c for c in batch.schema.names if c in ("g", "subroot", "root")]
        found = [batch.column(c).take(pa.array(taken, pa.int64())) for c in same]
        found += [pa.array(ranks, pa.int64()), pa.array(digests, pa.binary()), pa.array(ways, pa.binary())]
        if "leaves" in batch.schema.names:
            found.append(batch.column("leaves").flatten())
        names = [*same, "rank", "digest", "way", *(["leaf"] if "leaves" in batch.schema.names else [])]
        yield pa.RecordBatch.from_arrays(found, names=names)


def descend(stages: list[DataFrame], starts: DataFrame) -> DataFrame:
    """Requests ``g, block, way`` (and ``subroot, root``) at the tops of trees, taken down to every leaf:
    ``g, rank, digest, way, leaf`` and what came along. A request meets the block that it names by digest
    (group and place tell equal blocks apart)."""
    along = [c for c in ("subroot", "root") if c in starts.columns]
    schema = f"g string, {''.join(c + ' binary, ' for c in along)}rank long, digest binary, way binary"
    requests = None
    for stage, blocks in reversed(list(enumerate(stages))):
        tops = starts.select("g", F.lit(0).cast("long").alias("idx"), "block", "way", *along)
        here = blocks.where((F.col("n") <= BLOCK)).join(tops, ["g", "idx", "block"])
        if requests is not None:
            inner = requests.select("g", F.col("rank").alias("idx"), F.col("digest").alias("block"), "way", *along)
            here = here.unionByName(blocks.where(F.col("n") > BLOCK).join(inner, ["g", "idx", "block"]))
        kind = dict(blocks.dtypes).get("leaves")
        requests = here.mapInArrow(_down, schema + (f", leaf {kind[6:-1]}" if stage == 0 else ""))
    return requests


def manifest(documents: DataFrame, fields: tuple[str, ...] = FIELDS, by: str = "source", order: str = "doc_id", other: dict[str, Column] | None = None) -> DataFrame:
    """One row per document, repeated rows included: ``<order>, leaf, subroot, root, way`` (digests as 32
    bytes; :func:`proof_steps` reads the way) and ``other_leaf``, the digest of the row with the values of
    ``other`` in place of its own.

    Nulls are values of their own in any column (a null group is a group, the first; a null order comes
    first). Equal rows are equal leaves side by side; rows that share an order value only are sorted by
    digest. An empty table gives no row; other columns take no part, whatever their names."""
    ready(documents.sparkSession)
    changed = {f: (other or {}).get(f, F.col(f)) for f in fields}
    group = F.when(F.col(by).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(by).cast("string")))
    leaf, also = row_digest(*[F.col(f) for f in fields]), row_digest(*changed.values())
    rows = documents.select(group.alias("g"), F.col(order).alias("key"), leaf.alias("digest"), also.alias("other"))
    below = grow(ranked(rows, ["key", "digest"]), ["key", "other"])
    subroots = None
    for blocks in below:
        found = blocks.where(F.col("n") <= BLOCK).select(F.col("g").alias("key"), F.col("block").alias("digest"))
        subroots = found if subroots is None else subroots.unionByName(found)
    above = grow(ranked(subroots.withColumn("g", F.lit("")), ["key"]), ["key"])
    top = above[-1].where(F.col("n") <= BLOCK).select("g", "block", F.lit(b"").alias("way"), F.col("block").alias("root"))
    groups = cut(descend(above, top)).select(
        F.col("leaf.key").alias("g"), F.col("digest").alias("block"), "way", F.col("digest").alias("subroot"), "root"
    )
    return descend(below, groups).select(
        F.col("leaf.key").alias(order), F.col("digest").alias("leaf"), "subroot", "root", "way", F.col("leaf.other").alias("other_leaf")
    )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        proofs, folded = [], []
        for way, leaf in zip(batch.column("way").to_pylist(), batch.column("other_leaf").to_pylist()):
            steps, digest = proof_steps(way), leaf.hex()
            proofs.append(joined_digest([d for left, right in steps for d in left + right]))
            for left, right in steps:
                digest = joined_digest([*left, digest, *right])
            folded.append(digest)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(proofs), pa.array(folded)], names=[*batch.schema.names, "proof_sha256", "folded_root"]
        )


def verified(entries: DataFrame) -> DataFrame:
    """Adds to a :func:`manifest`: ``proof_sha256`` (digest over the proof's siblings), ``folded_root`` (the
    root that ``other_leaf`` leads to with these siblings) and ``verified`` (it is the root)."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entries.schema.fields)
    found = entries.mapInArrow(_verify, f"{kinds}, proof_sha256 string, folded_root string")
    return found.withColumn("verified", F.unhex("folded_root") == F.col("root"))
