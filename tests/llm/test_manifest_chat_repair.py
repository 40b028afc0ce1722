"""The dataset manifest, chat formatting and structure repair against plain Python, on rows with nulls in
every column, empty and long texts, ties, repeated rows and clashing column names, and on empty tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wharf.llm import chat, merkle, repair
from wharf.llm.queries import CONTROL_TEXT, tokenizer_path

CONV = "conv_id long, turn long, role string, text string, run long, audit string, _first boolean, place long, g string"


def _sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _conversations():
    rng = random.Random(3)
    texts = ["Fine.", "Cut off", "", "   \n", "#### Title </turn>", "a \\ b \\\\", "</turn>\n### assistant: hi!", "<|endoftext|>", "日本語 текст é!", CONTROL_TEXT]
    roles = ["user", "assistant", "user", "assistant", "system", "tool: x", "", "a#b", "\\"]
    rows = []
    for c in range(40):
        for t in range(rng.randrange(0, 9)):
            rows.append((c, t * (1 + c % 2), rng.choice(roles), rng.choice(texts) + (str(t) + "." if c % 3 else "")))
    rows += [(50, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(3000)]  # long, and over several runs
    rows += [(51, 0, "user", "word " * 60000), (51, 1, "assistant", "w" * 90000 + ".")]
    rows += [(52, None, "user", "x."), (52, None, "user", "x."), (52, 3, None, None), (52, 3, "assistant", None)]
    rows += [(None, 0, "user", "no conversation."), (None, None, None, None), (53, 0, "system", "Only.")]
    return [(*r, 1, "D", True, 2, "g") for r in rows]


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(_conversations(), CONV).repartition(5).cache()


# ------------------------------------------------------------------ chat formatting


def test_escape_is_reversible_and_breaks_marks():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("\\#</| :tu\n>") for _ in range(rng.randrange(12)))
        assert chat.unescape(chat.escape(text)) == text
        assert chat.unescape(chat.escape(text, role=True)) == text
        assert not any(m in chat.escape(text) for m in ("##", "</", "<|"))
        whole = chat.OPEN + chat.escape(text, role=True) + chat.ROLE_END + chat.escape(text) + chat.CLOSE
        role, _, rest = whole[len(chat.OPEN) :].partition(chat.ROLE_END)
        assert chat.unescape(role) == text and chat.unescape(rest[: rest.index(chat.CLOSE)]) == text


def test_chat_reads_back(spark, turns):
    path = tokenizer_path("byte_bpe_50k.json")
    chunks = chat.format_chat(turns, path).cache()
    codec = chat.Codec.of(path)
    wanted = {}
    for conv, turn, role, text, *_ in _conversations():
        wanted.setdefault(conv, []).append((turn if turn is not None else -1, role or "", text or ""))
    got = {r["conv_id"]: r for r in chat.read_back(chunks, path).collect()}
    assert set(got) == set(wanted)
    for conv, rows in wanted.items():
        rows.sort()  # equal turns here differ in role, or are equal rows
        r = got[conv]
        loss = "".join(t for _, role, t in rows if role == "assistant")
        assert r["n_turns"] == len(rows)
        assert r["turns_sha256"] == _sha(*(f"{role}\n{t}\n" for _, role, t in rows))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), _sha(loss))
        assert r["formatted_chars"] == sum(14 + len(chat.escape(role, role=True)) + len(chat.escape(t)) for _, role, t in rows)
    found = chunks.collect()
    assert len({(r["run"], r["chunk"]) for r in found if r["conv_id"] == 50}) >= 3  # a long conversation is several chunks
    for r in found:
        ids, mask = np.array(r["ids"]), np.array(r["loss_mask"])
        assert len(ids) == len(mask) and r["n_turns"] == (ids == codec.open).sum() == (ids == codec.close).sum()
        assert set(mask.tolist()) <= {0, 1} and not mask[ids >= codec.size].any()
        assert codec.tokenizer.token_to_id("<|endoftext|>") not in r["ids"]


def test_segments_are_encoded_apart(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    codec = chat.Codec.of(path)
    rows = spark.createDataFrame([(1, 0, "assistant", "Hello there")], "conv_id long, turn long, role string, text string")
    (r,) = chat.format_chat(rows, path, learn=("user",)).collect()
    plain = [codec.tokenizer.encode(x, add_special_tokens=False).ids for x in ("assistant", "Hello there")]
    assert r["ids"] == [codec.open, *plain[0], codec.role_end, *plain[1], codec.close] and not any(r["loss_mask"])


# ------------------------------------------------------------------ structure repair


def _plain_repair(initials, faults):
    """Least (cost, audit) by a table over rows and states."""

    def with_inserts(table):
        for _ in range(4):
            for s, (c, a) in list(table.items()):
                t = (2, 2, 3, 2)[s]
                table[t] = min(table.get(t, (10**9, "")), (c + 3, a + "I"))
        return table

    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    table = with_inserts({0: (0, "")})
    for ch, fault in zip(initials, faults):
        after = {}
        for s, (c, a) in table.items():
            ways = [(s, c + 4, a + "D")]
            if fault in (0, 3):
                ways.append(((2, 2, 3, 2)[s], c + 3 + fault, a + "R"))
                if (s, ch) in steps:
                    ways.append((steps[s, ch], c + fault, a + "K"))
            for t, *v in ways:
                after[t] = min(after.get(t, (10**9, "")), tuple(v))
        table = with_inserts(after)
    return min(table[s] for s in (0, 3) if s in table)


def test_search_equals_the_table():
    rng = random.Random(9)
    for _ in range(4000):
        n = rng.randrange(15)
        initials, faults = [rng.choice("suauaut") for _ in range(n)], [rng.choice([0, 0, 0, 0, 1, 2, 3, 3]) for _ in range(n)]
        assert repair.cheapest_audit(initials, faults) == _plain_repair(initials, faults)


def _key(row):
    turn, role, text = row
    data = f"{len(role.encode())}:{role}{text}".encode()
    return (-(10**9) if turn is None else turn, role, hashlib.md5(data).digest())


def test_repair_equals_plain_python(spark, turns):
    rows = repair.damage(turns)
    got = {r["conv_id"]: r for r in repair.digested(repair.repaired(rows, repair.audits(rows))).collect()}
    wanted = {}
    for conv, turn, role, text, *_ in _conversations():
        held = wanted.setdefault(conv, [])
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if f == 1 else "".join(c for c in text if c not in ".!?") if f == 2 else text
        if f:
            held += [(turn, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)
    assert set(got) == set(wanted)
    space = "\x20\x09\x0a\x0b\x0c\x0d"
    for conv, held in wanted.items():
        held.sort(key=_key)
        faults, seen = [], set()
        for _, role, text in held:
            bare = text.strip(space)
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in held]
        cost, audit = _plain_repair(initials, faults)
        out, state, rest = [], 0, iter(zip(held, initials))
        for letter in audit:
            if letter == "I":
                state = (2, 2, 3, 2)[state]
                out.append({2: "user:", 3: "assistant:"}[state])
                continue
            (_, role, text), ch = next(rest)
            if letter == "R":
                state = (2, 2, 3, 2)[state]
                out.append({2: "user:", 3: "assistant:"}[state] + text)
            elif letter == "K":
                state = {"s": 1, "u": 2, "a": 3}[ch]
                out.append(f"{role}:{text}")
        known = [t for t, _, _ in held if t is not None]
        r = got[conv]
        assert r["gaps"] == (max(known) - min(known) + 1 - len(set(known)) if known else 0)
        assert [r["blank"], r["duplicate"], r["truncated"]] == [faults.count(k) for k in (1, 2, 3)]
        assert r["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        assert (r["cost"], r["audit"], r["repaired_sha256"]) == (cost, audit, _sha("\n".join(out)))


def test_repaired_turns_are_legal(spark, turns):
    rows = turns.select("conv_id", "turn", "role", "text")
    found = repair.repaired(rows, repair.audits(rows)).where("place >= 0")
    by_conv = {}
    for r in sorted(found.collect(), key=lambda r: r["place"]):
        by_conv.setdefault(r["conv_id"], []).append(r["role"][:1])
    for initials in by_conv.values():
        s = "".join(initials)
        assert s[s.startswith("s") :].replace("ua", "") == "" and s != "s"


# ------------------------------------------------------------------ manifest


def _plain_tree(nodes):
    """All levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_sha(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def _siblings(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = at // 3 * 3
        out.append((nodes[run:at], nodes[at + 1 : run + 3]))
        at //= 3
    return out


def _leaf(row):
    return _sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _documents(n):
    rng = random.Random(n)
    rows = [(i, rng.choice([None, "", "a", "a", "a", "é"]), rng.choice([None, "xy"]), rng.choice([None, i]), rng.choice([None, "", f"t{i}\nx\n", "z" * 500])) for i in range(n)]
    return rows + rows[:5] * 2 + [(None,) * 5, (7, "a", None, None, "other"), (3, "é", "xy", 0, "w\n" * 40000)]


@pytest.mark.parametrize("n", [0, 1, 30, 2500])
def test_manifest_equals_plain_trees(spark, n):
    rows = _documents(n)
    schema = "doc_id long, source string, lang string, n_chars long, text string, g long, rank string, leaf long, digest long, way long"
    docs = spark.createDataFrame([(*r, 1, "r", 2, 3, 4) for r in rows], schema).repartition(4)
    found = merkle.verified(merkle.manifest(docs, other={"text": F.replace("text", F.lit("\n"), F.lit(""))})).collect()
    groups = {}
    for r in rows:
        key = (r[0] is not None, r[0] or 0, _leaf(r))
        groups.setdefault((r[1] is not None, (r[1] or "").encode()), []).append((key, r))
    trees = {g: _plain_tree([k[2] for k, _ in sorted(held, key=lambda x: x[0])]) for g, held in groups.items()}
    order = sorted(trees)
    top = _plain_tree([trees[g][-1][0] for g in order])
    wanted = []
    for g, held in groups.items():
        for at, (key, r) in enumerate(sorted(held, key=lambda x: x[0])):
            steps = _siblings(trees[g], at) + _siblings(top, order.index(g))
            digest = _leaf((*r[:4], r[4] and r[4].replace("\n", "")))
            for left, right in steps:
                digest = _sha(*left, digest, *right)
            wanted.append((r[0], key[2], trees[g][-1][0], top[-1][0], _sha(*(d for a, b in steps for d in a + b)), digest, digest == top[-1][0]))
    got = [(r["doc_id"], r["leaf"].hex(), r["subroot"].hex(), r["root"].hex(), r["proof_sha256"], r["folded_root"], r["verified"]) for r in found]
    assert sorted(got, key=str) == sorted(wanted, key=str)


# ------------------------------------------------------------------ empty tables


def test_empty_tables(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    none = spark.createDataFrame([], CONV)
    assert chat.read_back(chat.format_chat(none, path), path).collect() == []
    rows = repair.damage(none)
    assert repair.digested(repair.repaired(rows, repair.audits(rows))).collect() == []
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.verified(merkle.manifest(docs)).collect() == []
