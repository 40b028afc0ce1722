"""Repair of a conversation's structure: the cheapest edits that give it legal turns.

Legal are role initials ``(s?(ua)+)?``: perhaps a system turn, then user and assistant in turn, or nothing.
Edits: keep a row (K, free), give it the role user or assistant (R), delete it (D), insert an empty turn (I);
blank and repeated rows must be deleted, and a truncated row costs something while it stays. A lattice node
is (rows passed, what the last legal turn was); an audit is the edits' letters on a way through it.

The search is Dijkstra's from both ends: a heap of ways from the start and one of ways from the ends, until
no pair of them can be as cheap as the best crossing found. Every node on a cheapest way is then settled
from one side at least. From a node each letter leads to one node only, so the least audit of the cheapest
ways, over all crossings, is a walk that takes the least letter that stays on one of them.

Rows' texts are never gathered: the search sees an initial, a fault and a digest per row (some dozens of
bytes); the audit then meets the texts in a second, streamed pass.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharf.llm.common import ready

REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3  # costs; CUT_OFF: of a truncated row that stays
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
# States: nothing yet, after a system, a user, an assistant turn; legal steps by role initial, and the
# role that a new turn must have.
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_ENDS = (0, 3)
_SPACE = r"\x20\x09-\x0D"
STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def cheapest_audit(initials: list[str], faults: list[int]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of rows; of audits of that cost, the least by ASCII."""
    n = len(initials)

    def onward(node: int) -> list[tuple[str, int, int]]:
        """(letter, cost, target), letters ascending."""
        i, s = divmod(node, 4)
        out = []
        if i < n:
            out.append(("D", DELETE, node + 4))
        out.append(("I", INSERT, i * 4 + _NEXT[s]))
        if i < n and faults[i] in (FINE, TRUNCATED):
            stays = CUT_OFF if faults[i] == TRUNCATED else 0
            kept = _STEP.get((s, initials[i]))
            if kept is not None:
                out.append(("K", stays, i * 4 + 4 + kept))
            out.append(("R", REROLE + stays, i * 4 + 4 + _NEXT[s]))
        return out

    def back(node: int) -> list[tuple[str, int, int]]:
        i, t = divmod(node, 4)
        before = [s for s in range(4) if _NEXT[s] == t]
        out = [("I", INSERT, i * 4 + s) for s in before]
        if i:
            out.append(("D", DELETE, node - 4))
            if faults[i - 1] in (FINE, TRUNCATED):
                stays = CUT_OFF if faults[i - 1] == TRUNCATED else 0
                out += [("K", stays, i * 4 - 4 + s) for s in range(4) if _STEP.get((s, initials[i - 1])) == t]
                out += [("R", REROLE + stays, i * 4 - 4 + s) for s in before]
        return out

    ends = [n * 4 + s for s in _ENDS]
    dist = ({0: 0}, {e: 0 for e in ends})
    settled: tuple[dict[int, int], dict[int, int]] = ({}, {})
    heaps = ([(0, 0)], [(0, e) for e in ends])
    steps = (onward, back)
    best = 0 if n == 0 else DELETE * n  # to delete all rows is legal
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, node = heapq.heappop(heaps[side])
        if node in settled[side]:
            continue
        settled[side][node] = cost
        far = dist[1 - side].get(node)
        if far is not None and cost + far < best:
            best = cost + far
        for _, c, target in steps[side](node):
            if target not in settled[side] and cost + c < dist[side].get(target, best + 1):
                dist[side][target] = cost + c
                heapq.heappush(heaps[side], (cost + c, target))
    ahead, behind = settled
    marked: set[int] = set()  # nodes settled from the start that lead to a crossing of the best cost

    def good(node: int, cost: int) -> bool:
        if node in behind or node in ends:
            return cost + behind.get(node, 0) == best
        return node in marked and ahead[node] == cost

    # rows passed descending, and within them the dearer first: every step leads to an earlier one in this order
    for node in sorted(ahead, key=lambda x: (-(x >> 2), -ahead[x])):
        if node not in behind and any(good(target, ahead[node] + c) for _, c, target in onward(node)):
            marked.add(node)
    audit, node, cost = [], 0, 0
    while not (cost == best and node in ends):
        letter, c, node = next(e for e in onward(node) if good(e[2], cost + e[1]))
        audit.append(letter)
        cost += c
    return best, "".join(audit)


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds to ``role, text`` rows ``_initial``, ``_blank``, ``_open`` (no sentence end at the end) and
    ``_same`` (a digest of role and text)."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    same = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    return rows.select(
        "*",
        F.substring(role, 1, 1).alias("_initial"),
        (~text.rlike(f"[^{_SPACE}]")).alias("_blank"),
        (~text.rlike(rf"[.!?][{_SPACE}]*\z")).alias("_open"),
        same.alias("_same"),
    )


class _Conversation:
    """What the search needs of a conversation's rows, taken in order."""

    def __init__(self) -> None:
        self.initials: list[str] = []
        self.faults: list[int] = []
        self.seen: set[bytes] = set()
        self.turns: set[int] = set()

    def take(self, turn: int | None, initial: str, blank: bool, cut_off: bool, same: bytes) -> None:
        self.faults.append(BLANK if blank else DUPLICATE if same in self.seen else TRUNCATED if cut_off else FINE)
        self.seen.add(same)
        self.initials.append(initial)
        if turn is not None:
            self.turns.add(turn)

    def row(self) -> tuple:
        gaps = max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0
        counts = [self.faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(self.initials, self.initials[1:]))
        return gaps, *counts, illegal, *cheapest_audit(self.initials, self.faults)


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    ``rows`` has ``conv_id, turn, role, text`` and perhaps ``gone`` (a row that is not there, but whose
    conversation is); other columns take no part. Rows are taken by turn (null first), those of one turn by
    role and then by a digest of role and text. Null roles and texts count as one space, so such a role has
    to be replaced and such a text is blank; rows without a conversation make one of their own. Repeated
    rows are duplicates. A conversation without rows has zeros and an empty audit; an empty table gives no
    row. A conversation's initials and digests go through one task; its texts do not."""
    ready(rows.sparkSession)
    kind = dict(rows.dtypes)["conv_id"]
    names = ["turn", "_initial", "_blank", "_open", "_same", "_gone"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, key, out, id_type = None, None, [], None
        kinds = [pa.int64()] * 6 + [pa.string()]

        def send() -> pa.RecordBatch:
            nonlocal out
            columns = [pa.array(list(c), k) for c, k in zip(zip(*out), [id_type, *kinds])]
            out = []
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", *[x.split()[0] for x in STATS.split(", ")]])

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv, *fact, gone in zip(*[batch.column(c).to_pylist() for c in ("conv_id", *names)]):
                if state is None or conv != key:
                    if state:
                        out.append((key, *state.row()))
                    key, state = conv, _Conversation()
                if not gone:
                    state.take(*fact)
            if len(out) > 1000:
                yield send()
        if state:
            out.append((key, *state.row()))
            yield send()

    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    facts = with_faults(rows.select("conv_id", "turn", "role", "text", gone.alias("_gone")))
    facts = facts.select("conv_id", "role", *names).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "_same")
    return facts.select("conv_id", *names).mapInArrow(run, f"conv_id {kind}, {STATS}")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: per conversation one row with its columns of ``found`` (:func:`audits`) and
    ``place`` -1, followed by its turns: ``conv_id, place, edit, role, text``. Rows of a conversation lie
    together and in order; texts pass by one batch at a time."""
    stats = [c for c in found.columns if c != "conv_id"]
    kinds = dict(found.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, audit, at, state, place = None, "", 0, 0, 0
        names = ["conv_id", *stats, "place", "edit", "role", "text"]
        none = (None,) * len(stats)
        out: list[tuple] = []

        def inserted() -> None:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                state = _NEXT[state]
                out.append((key, *none, place, "I", _ROLE[state], ""))
                at, place = at + 1, place + 1

        for batch in batches:
            types = [batch.schema.field(c).type for c in ("conv_id", *stats)] + [pa.int64(), pa.string(), pa.string(), pa.string()]
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "_first", "_initial", "role", "text", *stats)]
            for conv, first, initial, role, text, *values in zip(*columns):
                if first:
                    inserted()  # after the last row of the conversation before
                    key, audit, at, state, place = conv, values[stats.index("audit")], 0, 0, 0
                    out.append((conv, *values, -1, None, None, None))
                    continue
                inserted()
                letter = audit[at]
                at += 1
                if letter != "D":
                    if letter == "R":
                        state = _NEXT[state]
                        role = _ROLE[state]
                    else:
                        state = _STEP[state, initial]
                    out.append((key, *none, place, letter, role, text))
                    place += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), types)], names=names)
                out = []
        inserted()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), types)], names=names)

    there = rows.where(~F.col("gone")) if "gone" in rows.columns else rows
    there = with_faults(there.select("conv_id", "turn", "role", "text"))
    there = there.select(
        "conv_id", F.lit(False).alias("_first"), "turn", "role", "text", "_initial", "_same", *[F.lit(None).cast(kinds[c]).alias(c) for c in stats]
    ).fillna(" ", subset=["role", "text"])
    heads = found.select(
        "conv_id", F.lit(True).alias("_first"), *[F.lit(None).cast(dict(there.dtypes)[c]).alias(c) for c in ("turn", "role", "text", "_initial", "_same")], *stats
    )
    both = heads.unionByName(there).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", F.desc("_first"), "turn", "role", "_same")
    schema = f"conv_id {kinds['conv_id']}, {', '.join(f'{c} {kinds[c]}' for c in stats)}, place long, edit string, role string, text string"
    return both.drop("turn", "_same").mapInArrow(run, schema)


def digested(turns: DataFrame) -> DataFrame:
    """Per conversation of :func:`repaired` rows as they lie: its statistics and ``repaired_sha256`` over
    ``role:text`` lines."""
    own = ("place", "edit", "role", "text")
    stats = [f for f in turns.schema.fields if f.name not in own]
    names = [f.name for f in stats]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sha, started, out = None, None, False, []
        for batch in batches:
            types = [batch.schema.field(c).type for c in names] + [pa.string()]
            for place, role, text, *values in zip(*[batch.column(c).to_pylist() for c in ("place", "role", "text", *names)]):
                if place < 0:
                    if sha:
                        out.append((*head, sha.hexdigest()))
                    head, sha, started = values, hashlib.sha256(), False
                else:
                    sha.update(f"{chr(10) if started else ''}{role}:{text}".encode())
                    started = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), types)], names=[*names, "repaired_sha256"])
                out = []
        if sha:
            out = [(*head, sha.hexdigest())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), types)], names=[*names, "repaired_sha256"])

    return turns.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats) + ", repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults: by ``crc32(conv_id:turn) % 20``, 0 drops a row (it stays, marked
    ``gone``), 1 empties its text, 2 takes the sentence ends out, 3 repeats it, 4 makes its role ``user``.
    Nulls count as one space."""

    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    role = F.when(fault == 4, F.lit("user")).otherwise(known("role"))
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fault == 0).alias("gone"), copies.alias("_n"))
    return rows.select("conv_id", "turn", "role", "text", "gone", F.explode("_n").alias("_n")).drop("_n")
