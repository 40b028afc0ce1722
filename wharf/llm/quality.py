"""Quality rules by repetition coverage: rolling hashes of several n-gram lengths, in numpy.

One prefix sum over a batch's bytes gives the hash of every word and line; window hashes over the words
give every n-gram. A text is judged by how many of its characters lie inside n-grams and lines that occur
more than once in it. Rows of a batch are handled together; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wharf.llm.common import RollingHash, ready, slices, text_buffer, window_hash, word_spans

LENGTHS = (2, 3, 4, 5, 6, 7, 8, 9, 10)
# The most share of word characters inside the top n-gram (2 to 4 words) or inside all
# repeated n-grams (5 to 10 words), and inside repeated lines, as published for web corpora.
TOP_SHARE = {2: 0.20, 3: 0.18, 4: 0.16}
ALL_SHARE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_SHARE = 0.20
LEAST_WORDS = 10
LONG_WORDS = 300  # from here on the published limits stand; below, they are widened
REPEAT_PERCENT = 20  # words in repeated 5-word windows
SYMBOLS = b"#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = [f"top_{k}" for k in TOP_SHARE] + [f"dup_{k}" for k in ALL_SHARE] + ["dup_lines"]

_IS_SYMBOL = np.zeros(256, np.int64)
_IS_SYMBOL[list(SYMBOLS)] = 1


def _groups(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For items (row, key) in text order: order by key, group number along it, group sizes, first of group."""
    order = np.lexsort((keys, rows))
    r, k = rows[order], keys[order]
    head = np.ones(len(order), bool)
    head[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    number = np.cumsum(head) - 1
    return order, number, np.bincount(number, minlength=0), np.flatnonzero(head)


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts and coverage shares of every text of a column (null: all zero)."""
    raw, offsets = text_buffer(column)
    n = len(column)
    out = {c: np.zeros(n, np.int64) for c in COUNTS}
    out |= {c: np.zeros(n) for c in SHARES}
    if not len(raw):
        return out
    per_row = lambda weights: np.diff(np.concatenate([[0], np.cumsum(weights)])[offsets])
    out["n_symbols"] = per_row(_IS_SYMBOL[raw])
    starts, ends, rows = word_spans(raw, offsets)
    if not len(starts):
        return out
    out["n_words"] = np.bincount(rows, minlength=n)
    # characters before each byte: bytes that continue a character do not count
    chars = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=chars[1:])
    wide = chars[ends] - chars[starts]
    out["word_chars"] = np.bincount(rows, wide, minlength=n).astype(np.int64)
    words_total = np.maximum(out["word_chars"], 1)
    rolling = RollingHash(raw)
    words = rolling.spans(starts, ends)

    # lines with a word; a line is repeated if an earlier line of the text is equal
    breaks = np.flatnonzero(raw == 10)
    l_start = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1]))
    l_start = l_start[l_start < len(raw)]
    l_end = np.concatenate([l_start[1:], [len(raw)]])
    l_end = l_end - (raw[l_end - 1] == 10)
    l_row = np.searchsorted(offsets, l_start, side="right") - 1
    first_word = np.searchsorted(starts, l_start)
    last_word = np.searchsorted(starts, l_end)
    keep = last_word > first_word
    l_start, l_end, l_row, first_word, last_word = (x[keep] for x in (l_start, l_end, l_row, first_word, last_word))
    order, number, sizes, heads = _groups(l_row, rolling.spans(l_start, l_end))
    again = np.ones(len(order), bool)
    again[heads] = False  # stable sort: the head is the earliest line of its group
    dup = order[again]
    out["n_dup_lines"] = np.bincount(l_row[dup], minlength=n)
    before = np.concatenate([[0], np.cumsum(wide)])
    dup_chars = np.bincount(l_row[dup], before[last_word[dup]] - before[first_word[dup]], minlength=n)
    out["dup_lines"] = dup_chars / words_total

    for k in LENGTHS:
        if len(words) < k:
            break
        inside = rows[: len(rows) - k + 1] == rows[k - 1 :]
        at = np.flatnonzero(inside)
        if not len(at):
            continue
        order, number, sizes, heads = _groups(rows[at], window_hash(words, k)[at])
        if k in TOP_SHARE:
            # the n-gram that fills most characters, if it occurs at least twice
            filled = sizes * (before[at[order[heads]] + k] - before[at[order[heads]]])
            filled[sizes < 2] = 0
            top = np.zeros(n, np.int64)
            np.maximum.at(top, rows[at[order[heads]]], filled)
            out[f"top_{k}"] = np.minimum(top / words_total, 1.0)
            continue
        repeated = at[order[sizes[number] > 1]]
        if len(repeated):
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, repeated, 1)
            np.add.at(cover, repeated + k, -1)
            covered = np.cumsum(cover[:-1]) > 0
            if k == 5:
                out["n_repeat_words"] = np.bincount(rows[covered], minlength=n)
            out[f"dup_{k}"] = np.bincount(rows[covered], wide[covered], minlength=n) / words_total
    return out


def judge(m: dict[str, np.ndarray], strict: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept). ``strict``: the coverage limits of texts under LONG_WORDS words are this many
    times the published ones, which longer texts are held to."""
    base = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])
    bad = base.copy()
    for name, limit in [(f"top_{k}", v) for k, v in TOP_SHARE.items()] + [(f"dup_{k}", v) for k, v in ALL_SHARE.items()] + [("dup_lines", LINE_SHARE)]:
        bad |= m[name] > np.where(m["n_words"] < LONG_WORDS, min(strict * limit, 1.0), limit)
    return base, ~bad


def quality_rules(documents: DataFrame, strict: float = 2.0) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept`` and the coverage shares of every document.

    ``kept`` is false if the base rules fail or if more of the word characters than allowed lie inside the
    top 2 to 4-word n-gram, inside repeated 5 to 10-word n-grams, or inside repeated lines. The published
    limits are meant for prose of several hundred words: texts of LONG_WORDS words or more are held to them;
    ``strict`` = 2 doubles them for shorter ones, so that short clean documents stay.

    Null and empty texts have all counts 0 and fail the base rules. Rows that repeat are judged one by
    one; an empty table gives an empty result; other columns of ``documents`` do not matter.
    """
    ready(documents.sparkSession)
    names = [*COUNTS, "base_failed", "kept", *SHARES]
    kinds = ["long"] * len(COUNTS) + ["boolean"] * 2 + ["double"] * len(SHARES)
    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, " + ", ".join(f"{a} {b}" for a, b in zip(names, kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            m = measure(batch.column("text"))
            m["base_failed"], m["kept"] = judge(m, strict)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(m[c]) for c in names]], names=["doc_id", *names])

    return documents.select("doc_id", "text").mapInArrow(run, schema)
