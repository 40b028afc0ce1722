"""Chat formatting on the level of token ids.

A turn is ``### role: text</turn>`` and a line end. The three marks are reserved ids beyond the tokenizer's
own; role and text are encoded apart from them and from each other, and the reserved ids are spliced in.
No id of a text can thus be a mark, and no token spans one. The loss mask covers the ids of the texts of
learned roles: +1 where one starts, -1 where it ends, summed along the ids.

In the formatted text, too, marks are marks alone: a control string in a role or text is broken by a
backslash after its first character, and a backslash is doubled (:func:`escape`, :func:`unescape`). That
includes strings that the tokenizer takes for special tokens.

Turns are encoded where they lie. They are then dealt by conversation and run of ``RUN`` turn numbers, so a
long conversation lies over many tasks, and come out as chunks of about ``CHUNK`` ids, cut between turns.
:func:`read_back` streams a conversation's chunks in order with nothing held but two hash states.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.llm.common import ready, slices

# The template's marks.
OPEN, ROLE_END, CLOSE = "### ", ": ", "</turn>\n"
RUN = 1024  # turn numbers that are assembled together
CHUNK = 1 << 16  # ids of a chunk, about; a longer turn is a chunk of its own
OUT_IDS = 1 << 20  # ids of an Arrow batch, about

_CONTROL = re.compile(r"\\|(?<=#)#|(?<=<)[/|]")
_ROLE_CONTROL = re.compile(_CONTROL.pattern + r"|(?<=:) ")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str, role: bool = False) -> str:
    """``text`` without ``##``, ``</``, ``<|`` (and, in a role, colon and space): no mark can occur in it."""
    return (_ROLE_CONTROL if role else _CONTROL).sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Codec:
    """Encoding and decoding with a byte-level tokenizer file; one per Python worker and file (``of``)."""

    _kept: dict[str, "Codec"] = {}

    @classmethod
    def of(cls, path: str) -> "Codec":
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.open, self.role_end, self.close = range(self.size, self.size + 3)
        self.kind = np.dtype("<u2" if self.close < 1 << 16 else "<u4")  # of ids between tasks
        # a byte-level vocabulary spells bytes as printable characters: those that print stand for
        # themselves, the others for the characters from 256 on, in order
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
        self.bytes = [b""] * (self.size + 3)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        for i, mark in zip((self.open, self.role_end, self.close), (OPEN, ROLE_END, CLOSE)):
            self.bytes[i] = mark.encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode()


def _runs_of(batch: pa.RecordBatch, codec: Codec, learn: frozenset[str]) -> pa.RecordBatch:
    roles = [r or "" for r in batch.column("role").to_pylist()]
    texts = [escape(t or "") for t in batch.column("text").to_pylist()]
    spelled = {r: codec.encode([escape(r, role=True)])[0].tobytes() for r in set(roles)}
    columns = [pa.array([spelled[r] for r in roles], pa.binary()), pa.array([i.tobytes() for i in codec.encode(texts)], pa.binary())]
    columns += [pa.array([r in learn for r in roles]), batch.column("role"), batch.column("turn"), batch.column("conv_id")]
    return pa.RecordBatch.from_arrays(columns, names=["role_ids", "text_ids", "learned", "role", "turn", "conv_id"])


def _assembled(turns: list[tuple[bytes, bytes, bool]], codec: Codec) -> tuple[np.ndarray, np.ndarray]:
    """(ids, loss mask) of turns in a row."""
    parts, edges, at = [], [], 0
    marks = [np.array([m], codec.kind) for m in (codec.open, codec.role_end, codec.close)]
    for role, text, learned in turns:
        r, t = np.frombuffer(role, codec.kind), np.frombuffer(text, codec.kind)
        parts += [marks[0], r, marks[1], t, marks[2]]
        start = at + len(r) + 2
        at = start + len(t) + 1
        if learned:
            edges.append((start, start + len(t)))
    step = np.zeros(at + 1, np.int64)
    for start, end in edges:
        step[start] += 1
        step[end] -= 1
    return np.concatenate(parts).astype(np.int32), np.cumsum(step[:-1]).astype(np.int8)


def format_chat(conversations: DataFrame, tokenizer: str, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Chunks of formatted conversations: ``conv_id, run, chunk, n_turns, ids, loss_mask``; a conversation is
    its chunks in order of ``run`` and ``chunk``.

    ``conversations`` has ``conv_id, turn, role, text``; other columns take no part, whatever their names.
    Rows are taken by turn (null first), those of one turn by role and then by the bytes of their ids;
    repeated rows are repeated turns. A null role or text counts as empty, and rows without a conversation
    make one of their own. ``learn``: the roles whose texts are under the loss mask. An empty table gives no
    row."""
    ready(conversations.sparkSession)
    kinds, learned = dict(conversations.dtypes), frozenset(learn)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(tokenizer)
        for batch in slices(batches, "text"):
            yield _runs_of(batch, codec, learned)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(tokenizer)
        rows: list[tuple] = []  # chunks to send
        turns: list[tuple[bytes, bytes, bool]] = []  # of the chunk at hand
        key, chunk, size, waiting = None, 0, 0, 0

        def close() -> None:
            nonlocal turns, size, waiting, chunk
            if turns:
                ids, mask = _assembled(turns, codec)
                rows.append((*key, chunk, len(turns), ids, mask))
                waiting += len(ids)
                turns, size, chunk = [], 0, chunk + 1

        def send() -> pa.RecordBatch:
            nonlocal rows, waiting
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), types)]
            rows, waiting = [], 0
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "run", "chunk", "n_turns", "ids", "loss_mask"])

        types = None
        for batch in batches:
            types = types or [batch.schema.field("conv_id").type, pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int8())]
            for *here, role, text, learned_ in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "run", "role_ids", "text_ids", "learned")]):
                if here != key:
                    close()
                    key, chunk = here, 0
                more = (len(role) + len(text)) // codec.kind.itemsize + 3
                if size + more > CHUNK:
                    close()
                turns.append((role, text, learned_))
                size += more
                if waiting > OUT_IDS:
                    yield send()
        close()
        if rows:
            yield send()

    schema = "role_ids binary, text_ids binary, learned boolean, role string, turn {turn}, conv_id {conv_id}".format(**kinds)
    turns = conversations.select("conv_id", "turn", "role", "text").mapInArrow(encode, schema)
    run = F.coalesce(F.floor(F.col("turn") / RUN).cast("long"), F.lit(-(1 << 62)))
    turns = turns.withColumn("run", run).repartition("conv_id", "run")
    turns = turns.sortWithinPartitions("conv_id", "run", "turn", "role", "text_ids")
    found = f"conv_id {kinds['conv_id']}, run long, chunk int, n_turns long, ids array<int>, loss_mask array<tinyint>"
    return turns.select("conv_id", "run", "role_ids", "text_ids", "learned").mapInArrow(assemble, found)


class _Reader:
    """What a conversation's chunks say, read one after the other."""

    def __init__(self, codec: Codec) -> None:
        self.codec, self.turns, self.chars, self.loss_chars = codec, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def take(self, ids: np.ndarray, mask: np.ndarray) -> None:
        codec = self.codec
        self.chars += len(codec.decode(ids))
        marks = [np.flatnonzero(ids == m) for m in (codec.open, codec.role_end, codec.close)]
        for start, middle, end in zip(*[m.tolist() for m in marks]):
            role, text = (unescape(codec.decode(ids[a + 1 : b])) for a, b in ((start, middle), (middle, end)))
            self.all.update(f"{role}\n{text}\n".encode())
            self.turns += 1
        step = np.diff(mask, prepend=0, append=0)
        for start, end in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
            text = unescape(codec.decode(ids[start:end]))
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(chunks: DataFrame, tokenizer: str) -> DataFrame:
    """Per conversation, from ids and masks alone: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``. A digest over a conversation is sequential, so its chunks go through one task, as a
    stream: a chunk at a time, in order."""
    kind = dict(chunks.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, reader, key, rows = Codec.of(tokenizer), None, None, []
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        id_type = None

        def send() -> pa.RecordBatch:
            nonlocal rows
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), [id_type, *types])]
            rows = []
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for i, conv in enumerate(batch.column("conv_id").to_pylist()):
                if reader is None or conv != key:
                    if reader:
                        rows.append((key, *reader.row()))
                    key, reader = conv, _Reader(codec)
                reader.take(*[np.asarray(batch.column(c)[i].values) for c in ("ids", "loss_mask")])
            if len(rows) > 1000:
                yield send()
        if reader:
            rows.append((key, *reader.row()))
            yield send()

    ordered = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "run", "chunk").select("conv_id", "ids", "loss_mask")
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(run, schema)
