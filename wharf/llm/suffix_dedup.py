"""Suffix-array dedup: bytes inside long strings that start in more than one place.

Which places can hold equal strings is found first, by content: the smallest hash among the short k-grams
of a window of ``length`` bytes is the window's key, so equal windows have equal keys wherever they are.
Runs of windows whose key occurs once are done with. The other runs (stretches of some ``length`` to
2 * ``length`` bytes) are dealt by key; equal stretches are merged; and each task sorts the suffixes of its
stretches by induced sorting and reads repeated windows off the permuted common prefixes. Since equal
windows share a key, every shard's answer is whole.

A key with very many different stretches (the border of a passage that a third of all documents hold) is
split by content again: its windows are classed by their distance to the k-gram, and each class is keyed
by the bytes that its windows share, ever more narrowly, until the groups are small. Nothing is dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharf.llm.common import RollingHash, boxed, content_key, cut, ready, slices, text_buffer, unboxed
from wharf.llm.suffix_array import repeated

LENGTH = 400
GRAM = 32
SHARD_BYTES = 256 << 10  # stretches whose suffixes are sorted together, about
CROWDED = 1500  # different stretches of a key beyond which the key is split (1.2 MB; a task takes 0.1 GB for them)
FEW = 500_000  # crowded keys (some 10 MB) that are told from others by a broadcast; more are joined
SALT = 64  # parts over which the stretches of one key are dealt in that join
WIDTHS = (64, 16, 4, 1)  # classes of window distances when a key is split, ever narrower
ALONE = 1_000  # stretches without an order to find that a task answers together
SEEN = 100_000  # stretches that a task remembers so as not to send one twice


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every ``width`` neighbours."""
    have, out = 1, x
    while have * 2 <= width:
        out = pick(out[: len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


class Keys:
    """Window keys of a batch of texts."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> None:
        n, wide = len(raw), length - gram + 1
        self.wide = wide
        at = np.arange(n - gram + 1)
        self.grams = RollingHash(raw).spans(at, at + gram)
        self.keys = _sliding(self.grams, wide, np.minimum)  # by window start
        inside = np.zeros(n + 1, np.int32)  # windows that do not cross a text's end
        size = np.diff(offsets)
        long = size >= length
        np.add.at(inside, offsets[:-1][long], 1)
        np.add.at(inside, offsets[1:][long] - length + 1, -1)
        self.inside = np.cumsum(inside)[: len(self.keys)] > 0

    def marks(self) -> np.ndarray:
        """Places of the k-grams that are the key of a window."""
        k = np.where(self.inside, self.keys, 0)
        pad = np.zeros(self.wide - 1, np.uint64)
        most = _sliding(np.concatenate([pad, k, pad]), self.wide, np.maximum)[: len(self.grams)]
        return np.flatnonzero((self.grams == most) & (most > 0))

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) window of every run of windows with one key in one text."""
        at = np.flatnonzero(self.inside)
        if not len(at):
            return at, at
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (self.keys[at[1:]] != self.keys[at[:-1]])
        first = np.flatnonzero(new)
        return at[first], at[np.concatenate([first[1:], [len(at)]]) - 1]


def _signed64(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _anchors(documents: DataFrame, length: int, gram: int, id_type: str) -> DataFrame:
    """id, hash, key, count (2: more than one place in the text), for the distinct keys of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raw, offsets = text_buffer(batch.column("text"))
            if len(raw) < length:
                continue
            keys = Keys(raw, offsets, length, gram)
            at = keys.marks()
            row = np.searchsorted(offsets, at, side="right") - 1
            key = keys.grams[at]
            order = np.lexsort((key, row))
            row, key = row[order], key[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.concatenate([first, [len(row)]]))
            row = pa.array(row[first])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(row), batch.column("hash").take(row), pa.array(_signed64(key[first])), pa.array(np.minimum(times, 2).astype(np.int32))],
                names=["id", "hash", "key", "count"],
            )

    return documents.mapInArrow(run, f"id {id_type}, hash long, key long, count int")


STRETCH = "id {id}, hash long, at long, size int, key long, content binary, anchor int, bytes binary"


def _stretches(documents: DataFrame, length: int, gram: int, id_type: str) -> DataFrame:
    """Runs of windows whose key is among the row's ``keys``: where they are and, the first time that a
    task meets them, their bytes."""
    names = [x.split()[0] for x in STRETCH.format(id=id_type).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in slices(batches, "text"):
            raw, offsets = text_buffer(batch.column("text"))
            if len(raw) < length:
                continue
            keys = Keys(raw, offsets, length, gram)
            first, last = keys.runs()
            row = np.searchsorted(offsets, first, side="right") - 1
            key = _signed64(keys.keys[first])
            keep = np.zeros(len(first), bool)
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            for i, wanted in enumerate(batch.column("keys")):
                a, b = bounds[i], bounds[i + 1]
                if a < b:
                    keep[a:b] = np.isin(key[a:b], wanted.values.to_numpy())
            first, last, row, key = first[keep], last[keep], row[keep], key[keep]
            if not len(first):
                continue
            contents, data = [], []
            buffer = raw.tobytes()
            for a, b in zip(first.tolist(), last.tolist()):
                part = buffer[a : b + length]
                h = hashlib.blake2b(part, digest_size=16).digest()
                contents.append(h)
                data.append(None if h in seen else part)
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(h)
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(rows), batch.column("hash").take(rows), pa.array(first - offsets[row]),
                    pa.array((last - first + length).astype(np.int32)), pa.array(key), pa.array(contents, pa.binary()),
                    pa.array(np.full(len(first), -1, np.int32)), pa.array(data, pa.binary()),
                ],
                names=names,
            )

    return documents.mapInArrow(run, STRETCH.format(id=id_type))


def _split(crowded: DataFrame, width: int, length: int, gram: int) -> DataFrame:
    """Parts of the different stretches of crowded keys: windows whose distance to the key's k-gram falls into
    one class of ``width``, keyed by the bytes that all windows of the class share.

    In: key, content, count, anchor, bytes. Out: the same, for the parts, with ``of_key``, ``of`` and ``shift``
    (the stretch and the part's place in it); at width 1 a part is one window, which its digest tells from
    others, and its bytes stay behind."""
    schema = "of_key long, of binary, shift int, count long, key long, content binary, anchor int, bytes binary"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                raw, windows = r["bytes"], len(r["bytes"]) - length + 1
                start = np.arange(windows)
                if r["anchor"] >= 0:
                    anchor = np.full(windows, r["anchor"])
                else:  # the first place of the smallest k-gram in each window
                    buffer = np.frombuffer(raw, np.uint8)
                    keys = Keys(buffer, np.array([0, len(buffer)]), length, gram)
                    place = np.where(keys.grams == keys.keys[0], np.arange(len(keys.grams)), len(keys.grams))
                    anchor = np.minimum.accumulate(place[::-1])[::-1][start]
                group = (anchor - start) // width
                edge = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (anchor[1:] != anchor[:-1])]))
                for a, b in zip(edge.tolist(), [*edge[1:].tolist(), windows]):
                    c, at = int(group[a]), int(anchor[a])
                    shared = raw[at - c * width : at - c * width - width + 1 + length]
                    part = raw[a : b - 1 + length]
                    name = hashlib.blake2b(b"%d %d %d " % (r["key"], width, c) + shared, digest_size=8).digest()
                    out.append((
                        r["key"], r["content"], a, r["count"], int.from_bytes(name, "little", signed=True),
                        hashlib.blake2b(part, digest_size=16).digest(), at - a, part if width > 1 else None,
                    ))
            if out:
                kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=names)

    return crowded.select("key", "content", "count", "anchor", "bytes").mapInArrow(run, schema)


def _search(groups: DataFrame, length: int) -> DataFrame:
    """key, content, spans: the repeated bytes of each stretch (key, content, count, bytes). A stretch that
    occurs more than once is repeated throughout; the rest is read off a suffix array per shard. Keys whose only
    stretch is such, or is a single window, say nothing of others and enter no suffix array."""
    schema = "key long, content binary, spans array<struct<a:int,b:int>>"

    def solve(rows: list[tuple], repeats: Iterable) -> pa.RecordBatch:
        keys, contents, spans = [], [], []
        for (key, content, count, data), starts in zip(rows, repeats):
            if count > 1:
                found = [{"a": 0, "b": len(data)}]
            elif len(starts):
                edge = np.flatnonzero(np.diff(starts) > 1)
                heads, tails = np.concatenate([[0], edge + 1]), np.concatenate([edge, [len(starts) - 1]])
                found = [{"a": int(starts[i]), "b": int(starts[j]) + length} for i, j in zip(heads, tails)]
            else:
                continue
            keys.append(key)
            contents.append(content)
            spans.append(found)
        kinds = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(contents, pa.binary()), pa.array(spans, kinds)], names=["key", "content", "spans"])

    def settled(group: list[tuple]) -> bool:
        return len(group) == 1 and (group[0][2] > 1 or len(group[0][3]) == length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        group: list[tuple] = []  # of one key
        alone: list[tuple] = []
        size = 0
        stretches = (row for batch in batches for row in zip(*[batch.column(c).to_pylist() for c in ("key", "content", "count", "bytes")]))
        for row in chain(stretches, [None]):
            if group and (row is None or row[0] != group[0][0]):
                if settled(group):
                    alone += group
                else:
                    rows += group
                    size += sum(len(r[3]) for r in group)
                group = []
            if rows and (row is None or size >= SHARD_BYTES):
                yield solve(rows, repeated([r[3] for r in rows], length))
                rows, size = [], 0
            if alone and (row is None or len(alone) >= ALONE):
                yield solve(alone, [()] * len(alone))
                alone = []
            if row is not None:
                group.append(row)

    dealt = groups.select("key", "content", "count", "bytes").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, schema)


def repeated_spans(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``id, hash, spans`` of the documents that hold repeated bytes: sorted byte spans (a, b), which may
    overlap, covered by a ``length``-byte string that also starts elsewhere in ``documents`` (id, hash, text)."""
    id_type = dict(documents.dtypes)["id"]
    anchors = cut(_anchors(documents, length, gram, id_type))
    common = anchors.groupBy("key").agg(F.sum("count").alias("n")).where("n > 1").select("key")
    wanted = anchors.join(common, "key").groupBy("id", "hash").agg(F.collect_set("key").alias("keys"))
    wanted = wanted.select(F.col("id").alias("_i"), F.col("hash").alias("_h"), "keys")
    held = documents.join(wanted, F.col("id").eqNullSafe(F.col("_i")) & (F.col("hash") == F.col("_h"))).select("id", "hash", "text", "keys")
    places = cut(_stretches(held, length, gram, id_type))

    def merged(rows: DataFrame, count: Column) -> DataFrame:
        """Different stretches of each key, with the number of their places."""
        return rows.groupBy("key", "content").agg(
            count.alias("count"), F.first("bytes", ignorenulls=True).alias("bytes"), F.first("anchor").alias("anchor")
        )

    def crowds(rows: DataFrame) -> tuple[DataFrame, int]:
        keys = cut(rows.groupBy("key").agg(F.count_distinct("content").alias("n")).where(F.col("n") > CROWDED).select("key"))
        return keys, keys.count()

    def told(rows: DataFrame, crowd: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
        """(rows of crowded keys, rows of the others); no key's rows meet in one task."""
        if n <= FEW:
            return tuple(rows.join(F.broadcast(crowd), "key", how) for how in ("left_semi", "left_anti"))
        salted = crowd.select("key", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("_salt"))
        dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("content"), F.lit(SALT)).cast("int"))
        return tuple(dealt.join(salted, ["key", "_salt"], how).drop("_salt") for how in ("left_semi", "left_anti"))

    places_of = F.count(F.lit(1))
    crowd, n = crowds(places)
    if not n:
        found = _search(merged(places, places_of), length)
    else:
        crowded, others = told(places, crowd, n)
        found = _search(merged(others, places_of), length)
        parts, levels = merged(crowded, places_of), []
        for width in WIDTHS:  # each different part is split once, however many stretches hold it
            parts = cut(_split(parts, width, length, gram))
            if width == 1:  # windows: all that occur more than once
                window = F.array(F.struct(F.lit(0).alias("a"), F.lit(length).alias("b"))).alias("spans")
                here = parts.groupBy("key", "content").agg(F.sum("count").alias("count")).where("count > 1").select("key", "content", window)
                levels.append((parts, here))
                break
            crowd, n = crowds(parts)
            if not n:
                levels.append((parts, _search(merged(parts, F.sum("count")), length)))
                break
            crowded, others = told(parts, crowd, n)
            levels.append((parts, _search(merged(others, F.sum("count")), length)))
            parts = merged(crowded, F.sum("count"))
        below = None
        for parts, here in reversed(levels):  # what is repeated in the parts is so in what they are part of
            here = here if below is None else here.unionByName(below)
            moved = F.transform("spans", lambda s: F.struct((s["a"] + F.col("shift")).alias("a"), (s["b"] + F.col("shift")).alias("b")))
            below = parts.select("key", "content", "of_key", "of", "shift").join(here, ["key", "content"])
            below = below.groupBy("of_key", "of").agg(F.flatten(F.collect_list(moved)).alias("spans")).withColumnsRenamed({"of_key": "key", "of": "content"})
        found = found.unionByName(below)
    spans = places.select("id", "hash", "at", "key", "content").join(found, ["key", "content"])
    spans = spans.select("id", "hash", F.transform("spans", lambda s: F.struct((s["a"] + F.col("at")).alias("a"), (s["b"] + F.col("at")).alias("b"))).alias("spans"))
    return spans.groupBy("id", "hash").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of sorted spans."""
    out: list[list[int]] = []
    for s in spans:
        if out and s["a"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["b"])
        else:
            out.append([s["a"], s["b"]])
    return [(a, b) for a, b in out]


def _with_spans(documents: DataFrame, columns: list[str], length: int, gram: int) -> DataFrame:
    """``row`` (the columns but the text), ``text`` and ``_spans`` (null: nothing repeats) of every document."""
    base = documents.select(F.col("doc_id").alias("id"), content_key("doc_id", "text").alias("hash"), "text")
    spans = repeated_spans(base, length, gram)
    spans = spans.select(F.col("id").alias("_i"), F.col("hash").alias("_h"), F.col("spans").alias("_spans"))
    rows = boxed(documents, columns).withColumn("_id", F.col("row.doc_id"))
    rows = rows.withColumn("_hash", F.xxhash64("_id", "text"))
    return rows.join(spans, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")), "left").select("row", "text", "_spans")


def _cut_out(text: pa.Scalar, spans: list[dict] | None) -> tuple[int, list[tuple[int, int]], bytes]:
    """(bytes of the text, maximal runs that go, what is left)."""
    raw = text.as_buffer().to_pybytes() if text.is_valid else b""
    runs = _merged(spans or [])
    at, parts = 0, []
    for a, b in runs:
        parts.append(raw[at:a])
        at = b
    parts.append(raw[at:])
    return len(raw), runs, b"".join(parts)


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """All columns of ``documents`` plus ``n_bytes``, ``n_removed``, ``removed`` (maximal byte spans that
    go) and ``kept_bytes`` (what is left of the UTF-8 text, in order). Such columns are replaced.

    A byte goes if a ``length``-byte string that also starts anywhere else, in this or another text, covers
    it. Strings are judged on the input, and no string crosses the end of a text. Null counts as empty;
    texts shorter than ``length`` bytes stay whole. Rows that repeat, even with equal ids, are texts of
    their own: what they hold is repeated. An empty table gives an empty result."""
    ready(documents.sparkSession)
    names = [c for c in documents.columns if c not in ("n_bytes", "n_removed", "removed", "kept_bytes")]
    rows = _with_spans(documents, names, length, gram)
    schema = rows.schema["row"].dataType.simpleString()
    schema = f"row {schema}, text string, n_bytes long, n_removed long, removed array<struct<a:long,b:long>>, kept_bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [_cut_out(text, spans) for text, spans in zip(batch.column("text"), batch.column("_spans").to_pylist())]
            size, runs, kept = zip(*found)
            gone = [sum(b - a for a, b in r) for r in runs]
            cuts = [[{"a": a, "b": b} for a, b in r] for r in runs]
            span_type = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(cuts, span_type), pa.array(kept, pa.binary())],
                names=["row", "text", "n_bytes", "n_removed", "removed", "kept_bytes"],
            )

    return rows.mapInArrow(run, schema).select(*unboxed(names), "n_bytes", "n_removed", "removed", "kept_bytes")


def without_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``documents`` with repeated bytes cut out of the text (bytes of characters cut in two go as well).
    Texts of which nothing is left but white space go, unless they were so before. ``n_chars`` follows the text."""
    ready(documents.sparkSession)
    cols = documents.columns
    rows = _with_spans(documents, cols, length, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, stays = [], []
            for text, spans in zip(batch.column("text"), batch.column("_spans").to_pylist()):
                left = _cut_out(text, spans)[2].decode("utf-8", "ignore") if spans else text.as_py()
                texts.append(left)
                stays.append(not spans or not (left == "" or left.isspace()))
            kept = pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])
            yield kept.filter(pa.array(stays, pa.bool_()))

    out = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string").select(*unboxed(cols))
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.length("text").cast(dict(documents.dtypes)["n_chars"]))
    return out.select(*cols)
