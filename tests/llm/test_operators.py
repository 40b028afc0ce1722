"""Each training-data operator against a brute-force version on a small fixture with null columns, empty
and long texts, ties, repeated rows and columns that clash with result names; and on an empty table."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, _hash long"


def _words(rng, n, vocab):
    return " ".join(rng.choice(vocab) for _ in range(n))


def _fixture():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdeéxyz") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    shared = _words(rng, 120, vocab)
    base = _words(rng, 90, vocab).split()
    texts = [None, "", "   \n\t ", "one", "Two words", "12 34 !!", "a" * 900, "ab " * 700, "Line one is here\n" * 30]
    texts += [_words(rng, rng.randrange(3, 200), vocab) for _ in range(40)]
    texts += [_words(rng, 30, vocab) + " " + shared + " " + _words(rng, 30, vocab) for _ in range(25)]
    for _ in range(30):  # a family of near copies, some beyond the threshold
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append(" ".join(w))
    texts += [_words(rng, 9000, vocab), "Über ñandú café – naïve 日本語 текст " * 3, "|<#>* $%& word " * 4]
    rows = [(i, t, None if i % 11 == 0 else "xy"[i % 2], [None, "s1", "s2", "s2"][i % 4], None, 0.5, True, 7) for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], rows[60], (None, texts[21], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    rows += [(500, texts[22], "x", "s1", 3, 0.1, False, 1)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_fixture(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _split(t):
    return (t or "").encode().split()


def test_near_duplicates(docs, none):
    from wharf.llm.neardup import keep_one, near_duplicates

    fold = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    for k, percent in ((3, 85), (5, 80)):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        sets = []
        for _, t in rows:
            w = (t or "").encode().translate(fold).split()
            sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
        root = list(range(len(rows)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for i in range(len(rows)):
            for j in range(i):
                common = len(sets[i] & sets[j])
                if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    root[find(i)] = find(j)
        groups = collections.defaultdict(list)
        for i in range(len(rows)):
            groups[find(i)].append(rows[i][0])
        least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
        expected = collections.Counter((rows[i][0], len(sets[i]), least[find(i)], rows[i][0] == least[find(i)]) for i in range(len(rows)))
        got = near_duplicates(docs, k, percent).select("doc_id", "n_shingles", "component_id", "kept").collect()
        assert collections.Counter(map(tuple, got)) == expected
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.where(r"text RLIKE '[^ \\n\\t]'").count() == len({find(i) for i in range(len(rows)) if sets[i]})
    assert near_duplicates(none).count() == 0 and keep_one(none).count() == 0


def test_long_lists_are_compared_in_blocks(spark, monkeypatch):
    from wharf.llm import neardup

    monkeypatch.setattr(neardup, "SHORT", 2)
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(60)]
    texts = []
    for _ in range(40):
        w = list(base)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(60)] = f"v{rng.randrange(9999)}"
        texts.append(" ".join(w))
    sets = [set(zip(t.split(), t.split()[1:], t.split()[2:])) for t in texts]
    root = list(range(40))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(40):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: find(i) for i in range(40)}


def _repeat_brute(texts, n):
    where = collections.Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - n + 1):
            if where[t[i : i + n]] > 1:
                gone[i : i + n] = [True] * n
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("crowded, few", [(1500, 10), (2, 10**6), (2, 0)])
def test_suffix_dedup(docs, none, monkeypatch, crowded, few):
    from wharf.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    monkeypatch.setattr(suffix_dedup, "FEW", few)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 2000)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = _repeat_brute([(t or "").encode() for _, t in rows], 120)
    found = suffix_dedup.remove_repeats(docs, length=120, gram=16)
    got = found.select("doc_id", "n_bytes", "n_removed", F.size("removed"), F.sha2("kept_bytes", 256)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter((i, *e) for (i, _), e in zip(rows, expected))
    left = suffix_dedup.without_repeats(docs, length=120)
    assert left.columns == docs.columns and left.where("text IS NULL").count() == 2
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_suffix_array():
    from wharf.llm.suffix_array import repeated, suffix_array

    rng = random.Random(1)
    for _ in range(150):
        x = [rng.randrange(rng.choice([1, 2, 4, 200])) + 1 for _ in range(rng.randrange(1, 200))] + [0]
        assert list(suffix_array(np.array(x, np.uint16), 202)) == sorted(range(len(x)), key=lambda i: x[i:])
    for size, most in ((4000, 255), (3000, 3), (2500, 40)):  # thousands of names, several levels of them
        x = bytes(rng.randrange(1, most + 1) for _ in range(size))
        x = x + x[size // 3 :] + x + b"\0"
        assert list(suffix_array(np.frombuffer(x, np.uint8), 256)) == sorted(range(len(x)), key=lambda i: x[i:])
    for _ in range(150):
        n = rng.choice([1, 2, 5, 12])
        texts = [bytes(rng.randrange(rng.choice([1, 3, 256])) for _ in range(rng.randrange(1, 60))) for _ in range(8)]
        texts.append(texts[0] + texts[1])
        where = collections.Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
        assert [list(g) for g in repeated(texts, n)] == [[i for i in range(len(t) - n + 1) if where[t[i : i + n]] > 1] for t in texts]


def test_quality(docs, none):
    from wharf.llm.quality import quality_rules

    def brute(t):
        w = _split(t)
        runs = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        inside = set()
        for i in range(len(w) - 4):
            if runs[tuple(w[i : i + 5])] > 1:
                inside |= set(range(i, i + 5))
        seen, dup = set(), 0
        for line in (t or "").encode().split(b"\n"):
            if line.split():
                dup += line in seen
                seen.add(line)
        n, symbols = len(w), sum(c in "#*$%&|<>" for c in t or "")
        return n, sum(len(x.decode()) for x in w), symbols, dup, len(inside), n < 10 or 100 * len(inside) > 20 * n

    got = quality_rules(docs)
    rows = got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert collections.Counter(map(tuple, rows)) == collections.Counter((r["doc_id"], *brute(r["text"])) for r in docs.collect())
    assert got.where("base_failed AND kept").count() == 0
    assert quality_rules(none).count() == 0


def test_quality_shares_and_verdict(spark, docs):
    from wharf.llm.quality import ALL_SHARE, LINE_SHARE, TOP_SHARE, quality_rules

    def brute(t):
        w = [x.decode() for x in _split(t)]
        total = max(1, sum(map(len, w)))
        share = {}
        for k in range(2, 11):
            runs = collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
            if k < 5:
                share[f"top_{k}"] = min(1.0, max((c * sum(map(len, g)) for g, c in runs.items() if c > 1), default=0) / total)
                continue
            inside = {j for i in range(len(w) - k + 1) if runs[tuple(w[i : i + k])] > 1 for j in range(i, i + k)}
            share[f"dup_{k}"] = sum(len(w[j]) for j in inside) / total
        seen, again = set(), 0
        for line in (t or "").split("\n"):
            if line.encode().split():
                again += sum(len(x.decode()) for x in line.encode().split()) * (line in seen)
                seen.add(line)
        share["dup_lines"] = again / total
        runs = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        inside = {j for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        limits = {f"top_{k}": v for k, v in TOP_SHARE.items()} | {f"dup_{k}": v for k, v in ALL_SHARE.items()} | {"dup_lines": LINE_SHARE}
        wide = 1 if len(w) >= 300 else 2
        kept = len(w) >= 10 and 5 * len(inside) <= len(w) and all(share[c] <= wide * v for c, v in limits.items())
        return share, kept

    # 17 % of the words lie in repeated 10-grams: a long text fails the published limits, a short one stays
    made = [(n, " ".join([f"v{i}" for i in range(n - 2 * r)] + 2 * [f"r{i}" for i in range(r)])) for n, r in ((400, 34), (150, 13), (299, 25), (300, 26))]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(1000 + n, t) for n, t in made], "doc_id long, text string"))
    text = {(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()): r["text"] for r in df.collect()}
    got = collections.defaultdict(list)
    for r in quality_rules(df).collect():
        got[r["doc_id"]].append(r)
    for (i, _), t in text.items():
        share, kept = brute(t)
        assert any(r["kept"] == kept and all(math.isclose(r[c], v, abs_tol=1e-12) for c, v in share.items()) for r in got[i]), i
    assert [got[1000 + n][0]["kept"] for n, _ in made] == [False, True, True, False]


def test_mixing(docs, none):
    from wharf.llm.mixing import mix, mixed_documents

    got = mix(docs).collect()
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(_split(r["text"]))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = dict(zip(order, [5, 2, 1] * len(order)))
    target, left, total = {}, set(order), sum(sizes.values())
    while left:  # share by weight; whoever is above its limit gets the limit, the rest is shared again
        rest, w = total - sum(target.values()), sum(weight[s] for s in left)
        above = {s for s in left if rest * weight[s] / w > 3 * sizes[s]}
        target |= {s: 3 * sizes[s] for s in above} if above else {s: rest * weight[s] / w for s in left}
        left = left - above if above else set()
    source = {(r["doc_id"], len(_split(r["text"]))): r["source"] for r in docs.collect()}
    taken = collections.Counter()
    for r in got:
        s = source[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], target[s]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert len(got) == docs.count() and all(abs(taken[s] - target[s]) <= 3 for s in sizes)
    assert sorted(map(str, mix(docs).collect())) == sorted(map(str, got))
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(_split(r["text"])) for r in mixed.collect()) == sum(taken.values())
    assert mix(none).count() == 0 and mixed_documents(none).count() == 0


@pytest.mark.parametrize("large", [4_300_000, 21_500])
def test_mixing_small_sources_meet_their_targets(spark, large):
    """Blocks have one size for every corpus, and a source of less than a block gets all of its words."""
    from wharf.llm.mixing import mix, mixed_documents

    words = [("a", 2150)] * (large // 2150) + [("b", 10), ("c", 65), ("d", 129)]
    df = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(words)], "doc_id long, source string, n int")
    df = df.select("doc_id", "source", F.expr("repeat('w ', n)").alias("text"))
    source = {i: s for i, (s, _) in enumerate(words)}
    taken, lengths = collections.Counter(), []
    for r in mix(df, block=64).collect():
        taken[source[r["doc_id"]]] += r["taken"]
        lengths += [x["to"] - x["from"] for x in r["spans"]]
    total = sum(n for _, n in words)
    assert taken == {"a": total - 612, "b": 30, "c": 195, "d": 387}
    assert max(lengths) == 64
    if large > 1_000_000:  # the texts themselves are made of the same spans
        return
    got = collections.Counter()
    for r in mixed_documents(df).groupBy("source").agg(F.sum(F.regexp_count("text", F.lit("w"))).alias("n")).collect():
        got[r["source"]] = r["n"]
    assert got == taken


@pytest.mark.parametrize("extra", [65, 150, 190])
def test_mixing_cuts_the_last_block(spark, extra):
    """One source of 129 words takes ``extra`` words beside a large one, whatever block is chosen last."""
    from wharf.llm.mixing import mix

    df = spark.createDataFrame([(1, "a", "w " * 129), (2, "b", "w " * 871)], "doc_id long, source string, text string")
    for seed in range(2):
        got = {r["doc_id"]: r for r in mix(df, seed=seed, weights=(extra, 1000 - extra), block=64).collect()}
        assert got[1]["taken"] == extra and got[2]["taken"] == 1000 - extra
        inside = sorted(w for x in got[1]["spans"] for w in range(x["from"], x["to"]))
        assert len(inside) == len(set(inside)) == extra - 129 * got[1]["rounds"]


def test_packing(docs, none):
    from tokenizers import Tokenizer

    from wharf.llm.packing import best_fit, bin_bound, pack, pieces
    from wharf.llm.queries import tokenizer_path

    path = tokenizer_path()
    whole = Tokenizer.from_file(path)
    expected = collections.Counter()
    for r in docs.collect():
        ids = np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        for k, a in enumerate(range(0, len(ids), 4096)):
            p = ids[a : a + 4096]
            expected[r["doc_id"], k, a, len(p), zlib.crc32(p.tobytes())] += 1
    got = pack(pieces(docs, path, with_ids=True), partition_tokens=20000).collect()
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= 1.1 * sum(r["length"] for r in got) / 4096 + 1
    assert pack(pieces(none, path)).count() == 0
    rng = np.random.default_rng(0)
    for _ in range(50):
        sizes = np.sort(rng.integers(1, 101, rng.integers(1, 60)))[::-1]
        b, o = best_fit(sizes, 100)
        assert bin_bound(sizes, 100) <= b.max() + 1 and np.bincount(b, sizes).max() <= 100
    assert bin_bound(np.array([60, 60, 60]), 100) == 3 and bin_bound(np.array([34, 34, 34]), 100) == 2


def test_token_ids_equal_the_tokenizers(docs):
    from tokenizers import Tokenizer

    from wharf.llm.queries import tokenizer_path
    from wharf.llm.tokens import TokenIds

    whole, mine = Tokenizer.from_file(tokenizer_path()), TokenIds.of(tokenizer_path())
    odd = ["Don't I'LL 's x's 1234 ÄÖ ß İ ǅ <|endoftext|>b", "a\x1fb c\x85d\xa0e ª²¼ é ŉ ĳ", "___ 12ab_c e\u0301 Σας", "\u0301x"]
    for t in odd + [r["text"] or "" for r in docs.collect()]:
        assert list(mine.ids(t)) == whole.encode(t, add_special_tokens=False).ids


def test_token_counts(docs, none):
    from wharf.llm.queries import tokenizer_path
    from wharf.llm.token_counts import SPACE, Unigram, token_counts

    path = tokenizer_path("piece_bpe_32k.model")
    u = Unigram.of(path)

    def brute(w):
        forward, best = [0.0], [(0.0, 0)]
        for i in range(1, len(w) + 1):
            sums, tops = [], []
            for j in range(i):
                n, s = 1, u.score.get(w[j:i])
                if s is None:
                    if i - j > 1:
                        continue
                    n = len(w[j:i].encode())
                    s = n * u.byte
                sums.append(forward[j] + s)
                tops.append((best[j][0] + s, -best[j][1] - n))
            forward.append(math.log(sum(math.exp(x - max(sums)) for x in sums)) + max(sums))
            best.append((max(tops)[0], -max(tops)[1]))
        return best[-1][1], forward[-1]

    small = docs.where("length(text) < 2000 OR text IS NULL")
    expected = {}
    for r in small.collect():
        each = [brute(SPACE + w.decode()) for w in _split(r["text"])]
        expected[r["doc_id"], len(each)] = (sum(e[0] for e in each), sum(e[1] for e in each))
    results = []
    for table in (1 << 19, 100, 1):  # all frequent words, the most frequent ones, none of them
        got = token_counts(small, path, table).collect()
        assert len(got) == small.count()
        for r in got:
            n, p = expected[r["doc_id"], r["n_words"]]
            assert r["n_tokens"] == n and math.isclose(r["log_prob"], p, rel_tol=1e-9, abs_tol=1e-9)
        results.append(collections.Counter(map(tuple, got)))
    assert results[0] == results[1] == results[2]
    assert token_counts(none, path).count() == 0


def test_frequent_words_keep_to_the_bound(docs):
    from wharf.llm.queries import tokenizer_path
    from wharf.llm.token_counts import frequent_words, word_counts

    path = tokenizer_path("piece_bpe_32k.model")
    brute = collections.Counter(w.decode() for r in docs.collect() for w in _split(r["text"]))
    assert {r["word"]: r["n"] for r in word_counts(docs).collect()} == brute
    assert len(frequent_words(docs, path, 1 << 19)[0]) == sum(n > 1 for n in brute.values())
    hashes = {r["h"]: r["n"] for r in word_counts(docs).collect()}
    for table in (1, 30, 200):
        found, tokens, scores = frequent_words(docs, path, table)
        assert len(found) <= table and len(found) == len(tokens) == len(scores) and sorted(found) == list(found)
        least = min((hashes[h] for h in found), default=math.inf)
        assert all(n < least for h, n in hashes.items() if h not in set(found))


def test_token_counts_of_a_very_long_word(spark):
    from wharf.llm.queries import tokenizer_path
    from wharf.llm.token_counts import token_counts

    path = tokenizer_path("piece_bpe_32k.model")
    rows = [(0, "ab" * 100_000), (1, "ab" * 100_000 + " ab"), (2, "ab")]
    got = {r["doc_id"]: r for r in token_counts(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()}
    assert [got[i]["n_words"] for i in range(3)] == [1, 2, 1]
    assert got[1]["n_tokens"] == got[0]["n_tokens"] + got[2]["n_tokens"]
    assert math.isclose(got[1]["log_prob"], got[0]["log_prob"] + got[2]["log_prob"], rel_tol=1e-12)


def test_nearest(spark):
    from wharf.llm.ann import nearest

    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 16)).astype("float32")
    x[50:60] = x[40]  # ties
    x[7] *= 1e30
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows[11], rows[12], rows[13], rows[14] = (11, None), (12, [0.0] * 16), (13, [None] + [1.0] * 15), (14, [float("nan")] * 16)
    rows += [(None, [1.0] * 16), (400, [1.0, 2.0]), (401, [1.0, 3.0]), (45, rows[45][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    expected = []
    for i, q in {i: q for i, q in ok if i % 20 == 0}.items():
        best = sorted(((-float(q @ c), j) for j, c in ok if j != i and len(c) == len(q)))[:20]
        expected += [(i, r + 1, j) for r, (_, j) in enumerate(best)]
    got = nearest(df, F.col("vec_id") % 20 == 0, 20).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == sorted(expected)
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_language(spark, docs, none):
    from wharf.llm.langid import label, train

    rng = random.Random(8)
    letters = {"p": "abcde", "q": "uvwxyz"}
    made = []
    for i in range(400):
        lang = "pq"[i % 2]
        made.append((i, " ".join("".join(rng.choice(letters[lang]) for _ in range(5)) for _ in range(rng.randrange(1, 60))), lang))
    df = spark.createDataFrame(made, "doc_id long, text string, lang string")
    model = train(df, steps=80)
    got = label(df, model).toPandas()
    assert set(got.held_out) == {True, False} and (got.lang_pred == got.lang)[got.held_out].mean() > 0.95
    assert list(got.held_out) == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]
    rest = label(docs, model)
    assert rest.count() == docs.count() and rest.where("score < 0 OR score > 1").count() == 0
    for r in rest.collect():
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    rare = [(1000 + i, "mnopk nopkm " * 20, "r") for i in range(6)]
    assert train(df.unionByName(spark.createDataFrame(rare, df.schema)), sample=30, steps=2).classes == ["p", "q", "r"]
    assert train(none) is None and label(docs, None).where("lang_pred != 'und'").count() == 0
    assert label(none, model).count() == 0


def test_toxicity(spark, docs, none):
    from wharf.llm.toxicity import severity, train

    rng = random.Random(9)
    vocab = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        w = [rng.choice(vocab) for _ in range(rng.randrange(5, 120))]
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["vile", "filth", "scorn"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 10 != 0), int(toxic)))
    labels += [(None, 1, 1), (3000, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = train(df, lab, exclude=F.col("doc_id") % 3 == 0)
    got = severity(df.where("doc_id % 3 = 0"), model).toPandas()
    truth = got.doc_id % 5 == 0
    assert got.toxic[truth].mean() > 0.9 and got.toxic[~truth].mean() < 0.05
    assert got.severity[truth].mean() > got.severity[~truth].mean() + 0.5
    assert severity(docs, model).count() == docs.count() and severity(none, model).count() == 0
    assert train(none, lab.limit(0)) is None and severity(docs, None).where("severity != 0 OR toxic").count() == 0


def test_toxicity_sample_has_whole_documents_of_every_grade(spark, monkeypatch):
    from wharf.llm import toxicity

    monkeypatch.setattr(toxicity, "fit", lambda rows: rows)
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(6000))
    df = spark.createDataFrame([(i, long if i == 7 else f"word{chr(97 + i % 26)}") for i in range(2000)], "doc_id long, text string")
    grades = [(i, int(i % 100 != 0), int(i % 100 == 0 or i % 2)) for i in range(2000)]
    lab = spark.createDataFrame(grades, "doc_id long, quality int, toxic int")
    rows = toxicity.train(df, lab, sample=100)
    counts = collections.Counter(g for *_, g in rows)
    assert len(rows) <= 100 and min(counts[g] for g in range(3)) >= 16
    (slots, values, _), = toxicity.train(df, lab.where("doc_id = 7"))
    assert len(slots) == len(values) > 5900


def test_url_filter(spark):
    from wharf.llm.queries import FIXED_RULES
    from wharf.llm.url_filter import url_filter

    urls = [
        None, "", "no scheme", "http://", "http://com/", "HTTP://A.Com/x", "https://www.example.com/en/1?q#f", "https://m.example.com/en/", "http://example.com/EN/",
        "http://xexample.com/en/", "http://a.net/fr/1", "http://net/es/", "http://a.net/en/", "http://a.net", "http://a.com?x/y", "x://y://b.com/", "http://www.example.com/en", "http://a..com//en/",
    ]
    urls += ["http://a.net/fr/1"] * 3 + ["http://" + "a." * 300 + "com/" + "x/" * 300]
    rows = [(i, u, "clash", "clash") for i, u in enumerate(urls)] + [(None, "http://b.net/fr/", None, None)]

    def brute(u):
        host = path = ""
        if u is not None and "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, tail = rest[:cut].lower(), rest[cut:]
            path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        fits = [(h + p, v) for v, h, p in FIXED_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=lambda f: len(f[0]), default=(None, "allow"))
        return host, path, *best

    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, host string")
    rules = spark.createDataFrame(FIXED_RULES, "verdict string, host string, path string")
    got = url_filter(pages, rules).select("page_id", "host", "path", "rule", "verdict").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter((r[0], *brute(r[1])) for r in rows)
    assert url_filter(pages.limit(0), rules).count() == 0 and url_filter(pages, rules.limit(0)).where("rule IS NOT NULL").count() == 0
    part = spark.createDataFrame([("block", "com", "/x/pa")], "verdict string, host string, path string")
    some = spark.createDataFrame([("http://com/x/path",), ("http://com/x/p",)], "url string")
    assert [r["verdict"] for r in url_filter(some, part).orderBy("url").collect()] == ["allow", "block"]


def test_cached_ids_equal_the_tokenizer_on_every_latin_character():
    from wharf.llm.queries import tokenizer_path
    from wharf.llm.tokens import TokenIds

    tokens = TokenIds.of(tokenizer_path())
    chars = [chr(c) for c in range(0x20, 0x250)]
    rng = random.Random(1)
    texts = [t for c in chars for t in (c, f"ab{c}cd", c + c)]
    texts += ["".join(rng.choice(chars) for _ in range(rng.randrange(30))) for _ in range(5000)]
    for text in texts:
        assert tokens.ids(text).tolist() == tokens.whole.encode(text, add_special_tokens=False).ids
