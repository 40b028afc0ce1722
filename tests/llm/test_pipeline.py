"""The corpus pipeline: each stage, on what the stage before it gives, against plain Python; nulls, empty
and long texts, ties, repeated rows and clashing columns; an empty table."""

import collections
import itertools
import re
import zlib

import pytest

import corpus_pipeline as P
from wharf.llm.common import cut
from wharf.llm.packing import bin_bound
from wharf.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    """Rows that go into the first stage, and those that each stage gives."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.collect()
    longest = max((r["text"] for r in first if r["text"]), key=len)
    more = [(9001, None, "en", "s", 1), (9002, "", None, None, None), (9003, " 12 3!", "en", None, 5), (None, longest + " tail", None, "s", 2), tuple(first[3]), tuple(first[3])]
    docs = cut(docs.unionByName(spark.createDataFrame(more, docs.schema)))
    out = [docs]
    for _, stage in P.STAGES:
        out.append(cut(stage(spark, out[-1], SF)))
    return [[r.asDict() for r in d.collect()] for d in out] + [docs.columns]


def _shingles(text, k=5):
    words = [w.translate(str.maketrans({c: c.lower() for c in map(chr, range(65, 91))})) for w in WORD.findall(text)]
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def test_language_id_keeps_rows_with_a_language(stages):
    before, after = stages[0], stages[1]
    key = lambda r: tuple(sorted(r.items(), key=lambda x: x[0]))
    left = collections.Counter(map(repr, map(key, before)))
    left.subtract(map(repr, map(key, after)))
    assert min(left.values()) >= 0  # rows are those of the input, unchanged
    assert all(any(c.isalpha() for c in r["text"] or "") for r in after)
    spoken = [r for r in before if len([w for w in WORD.findall(r["text"] or "") if w.isalpha()]) >= 20]
    kept = collections.Counter(repr(key(r)) for r in after)
    assert sum(kept[repr(key(r))] > 0 for r in spoken) >= 0.97 * len(spoken)


def test_near_dedup_equals_brute_force(stages):
    before, after = stages[1], stages[2]
    sets = [_shingles(r["text"]) for r in before]
    parent = list(range(len(before)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in itertools.combinations(range(len(before)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for i, r in enumerate(before):
        groups[find(i)].append(repr(sorted(r.items())))
    kept = collections.Counter(repr(sorted(r.items())) for r in after)
    assert len(after) == len(groups)
    assert all(any(kept[row] for row in rows) for rows in groups.values())


def test_suffix_dedup_equals_brute_force(stages):
    before, after = stages[2], stages[3]
    places = collections.defaultdict(int)
    raws = [r["text"].encode() for r in before]
    for raw in raws:
        for i in range(len(raw) - P.PASSAGE + 1):
            places[raw[i : i + P.PASSAGE]] += 1
    wanted = []
    for r, raw in zip(before, raws):
        gone = bytearray(len(raw))
        for i in range(len(raw) - P.PASSAGE + 1):
            if places[raw[i : i + P.PASSAGE]] > 1:
                gone[i : i + P.PASSAGE] = b"\x01" * P.PASSAGE
        if any(gone):
            text = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
            if not text or text.isspace():
                continue
            r = dict(r, text=text)
        wanted.append(repr(sorted(dict(r, n_chars=len(r["text"])).items())))
    assert sorted(repr(sorted(r.items())) for r in after) == sorted(wanted)


def test_mixing_meets_its_targets(stages):
    before, after = stages[3], stages[4]
    size, taken = collections.Counter(), collections.Counter()
    for rows, into in ((before, size), (after, taken)):
        for r in rows:
            into[r["source"]] += len(WORD.findall(r["text"]))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, free = sum(size.values()), {}, set(order)
    while True:  # targets stop at three times the source, the excess goes to the others by weight
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3 * size[s]
            free.remove(s)
    for s in order:
        assert abs(taken[s] - target[s]) <= 2, s
    texts = collections.defaultdict(list)
    for r in before:
        texts[r["doc_id"]].append(" ".join(WORD.findall(r["text"])))
    uses = collections.Counter()
    for r in after:
        words = " ".join(WORD.findall(r["text"]))
        uses[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"])
        if not any(words in t for t in texts[r["doc_id"]]):  # parts of one document, in order
            parts = iter(w for t in texts[r["doc_id"]] for w in t.split(" "))
            assert all(w in parts for w in words.split(" "))
    for i, n in uses.items():
        assert n <= 3 * sum(len(WORD.findall(t)) for t in texts[i])


def test_packing_places_every_piece(stages):
    from tokenizers import Tokenizer

    before, after = stages[4], stages[5]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    wanted = collections.Counter()
    for r in before:
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            wanted[r["doc_id"], k, at, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))] += 1
    assert wanted == collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in after)
    bins = collections.defaultdict(list)
    for r in after:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    import numpy as np

    assert len(bins) <= bin_bound(np.array([r["length"] for r in after]), 4096) + 1


def test_columns_and_run(spark, stages):
    columns = stages[-1]
    for rows in stages[1:5]:
        assert all(list(r) == columns for r in rows)
    found = P.run(spark, SF)
    assert found.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"] and found.count() > 0


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in P.STAGES[1:]:
        assert cut(stage(spark, cut(docs), SF)).count() == 0, name
