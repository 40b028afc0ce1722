"""Token counts under a unigram model, by dynamic programming that words share through a trie.

Distinct pre-tokens are put into a trie in their order. Each node holds, for its prefix, the forward score
(log probability of all segmentations), the score of the best segmentation and its number of tokens; a
prefix that many words share is scored once. As words come in order, only the nodes from the root to the
last word are open: the others are finished, and are let go. The values at the words' ends are kept.

Words are counted in Spark. Those that occur more than once, the most frequent ones up to a bound, are
scored once in the cluster, over ranges of words, and go to all tasks as a table of bounded size. Any other
word is scored with the batch that holds it. A document's counts are sums over its words.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.llm.common import RollingHash, cut, ready, slices, text_buffer, word_spans

TABLE = 1 << 19  # words scored beforehand: at most 20 bytes each in every task, 10 MB
SPACE = "▁"
FIXED = float(1 << 32)  # scores are summed as integers of 2**-32, so that no order of words changes a sum


class Unigram:
    """Pieces of a sentencepiece file with Zipf probabilities by rank: log p = -log(rank + 2) - log Z.

    The file orders its pieces but holds no probabilities, and tokenizers are not trained here, so the
    rank gives them. A character that no piece covers is spelt in byte pieces."""

    _kept: dict[str, "Unigram"] = {}

    @classmethod
    def of(cls, path: str) -> "Unigram":
        if path not in cls._kept:
            from sentencepiece import SentencePieceProcessor

            p = SentencePieceProcessor(model_file=path)
            normal = [p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_unknown(i) or p.is_control(i) or p.is_byte(i) or p.is_unused(i))]
            cls._kept[path] = cls(normal)
        return cls._kept[path]

    def __init__(self, pieces: list[str]) -> None:
        norm = math.log(sum(1 / (r + 2) for r in range(len(pieces) + 256)))
        self.score = {p: -math.log(r + 2) - norm for r, p in reversed(list(enumerate(pieces)))}
        self.byte = -math.log(len(pieces) + 257) - norm
        # the pieces from their last character back: a prefix's last pieces are found in one walk
        self.back: dict = {}
        for p, value in self.score.items():
            node = self.back
            for ch in reversed(p):
                node = node.setdefault(ch, {})
            node[""] = value

    def learn(self, words: Iterable[str]) -> tuple[list[int], list[float]]:
        """Tokens of the best segmentation and forward score of words, which come sorted."""
        # the open nodes, from the root to the last word
        forward, best, tokens = [0.0], [0.0], [0]
        path: list[str] = []
        counts, scores = [], []
        for w in words:
            depth, most = 0, min(len(w), len(path))
            while depth < most and path[depth] == w[depth]:
                depth += 1
            del path[depth:], forward[depth + 1 :], best[depth + 1 :], tokens[depth + 1 :]
            for ch in w[depth:]:
                path.append(ch)
                depth += 1
                self._open(path, depth, forward, best, tokens)
            counts.append(tokens[-1])
            scores.append(forward[-1])
        return counts, scores

    def _open(self, path: list[str], depth: int, forward: list[float], best: list[float], tokens: list[int]) -> None:
        """Score the node under ``path`` from those above it."""
        sums, top, count = [], -math.inf, 0
        back, before, ch = self.back, depth, path[-1]
        while before:
            back = back.get(path[before - 1])
            if back is None:
                break
            before -= 1
            score = back.get("")
            if score is not None:
                sums.append(forward[before] + score)
                value = best[before] + score
                if value > top or (value == top and tokens[before] + 1 < count):
                    top, count = value, tokens[before] + 1
        if ch not in self.score:  # spelt in bytes
            n = len(ch.encode("utf-8", "replace"))
            sums.append(forward[depth - 1] + n * self.byte)
            value = best[depth - 1] + n * self.byte
            if value > top or (value == top and tokens[depth - 1] + n < count):
                top, count = value, tokens[depth - 1] + n
        if len(sums) == 1:
            forward.append(sums[0])
        else:
            high = max(sums)
            forward.append(high + math.log(sum([math.exp(s - high) for s in sums])))
        best.append(top)
        tokens.append(count)


def _fixed(scores: list[float]) -> np.ndarray:
    return np.rint(np.array(scores, np.float64) * FIXED).astype(np.int64)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, rows, hashes) of the words of a column."""
    raw, offsets = text_buffer(column)
    starts, ends, rows = word_spans(raw, offsets)
    hashes = RollingHash(raw).spans(starts, ends).view(np.int64) if len(starts) else np.zeros(0, np.int64)
    return raw, starts, ends, rows, hashes


def _cut_out(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    return [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist())]


def word_counts(documents: DataFrame) -> DataFrame:
    """``h, word, n``: how often each word occurs in all texts, with its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raw, starts, ends, _, hashes = _words(batch.column("text"))
            h, at, n = np.unique(hashes, return_index=True, return_counts=True)
            words = pa.array(_cut_out(raw, starts[at], ends[at]), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(h), words, pa.array(n.astype(np.int64))], names=["h", "word", "n"])

    found = documents.select("text").mapInArrow(run, "h long, word string, n long")
    return found.groupBy("h", "word").agg(F.sum("n").alias("n"))


def frequent_words(documents: DataFrame, model: str, table: int = TABLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (sorted), tokens and scores of the words that occur more than once; if these are more than
    ``table``, of those with at least 2**b occurrences, for the least b that leaves no more than ``table``."""
    counts = cut(word_counts(documents).where("n > 1"))
    bits = (F.length(F.bin("n")) - 1).alias("b")
    by_bits = sorted(counts.groupBy(bits).agg(F.count(F.lit(1)).alias("c")).collect(), reverse=True)  # 63 rows at most
    least, total = 1 << 62, 0
    for b, c in by_bits:
        total += c
        if total > table:
            break
        least = 1 << b
    ranges = counts.where(F.col("n") >= least).select("h", "word").repartitionByRange("word").sortWithinPartitions("word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram = Unigram.of(model)
        for batch in batches:
            tokens, scores = unigram.learn([SPACE + w for w in batch.column("word").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(tokens, pa.int32()), pa.array(_fixed(scores))], names=["h", "t", "s"])

    got = ranges.mapInArrow(run, "h long, t int, s long").toArrow()
    h, t, s = (got.column(c).to_numpy() for c in ("h", "t", "s"))
    order = np.argsort(h)
    return h[order], t[order], s[order]


def token_counts(documents: DataFrame, model: str, table: int = TABLE) -> DataFrame:
    """``doc_id, n_words, n_tokens, log_prob`` of every document over its whole text; ``model`` is the path
    of a sentencepiece file on every machine, ``table`` the number of words scored beforehand at most (it
    bounds memory; results do not depend on it).

    Null, empty and blank texts count 0 with log probability 0. Equal scores go to fewer tokens. Rows that
    repeat are counted one by one; an empty table gives an empty result; other columns do not matter. A word
    of any length is scored whole. Words are told apart by 64-bit hashes."""
    ready(documents.sparkSession)
    kind = dict(documents.dtypes)["doc_id"]
    known, known_tokens, known_scores = frequent_words(documents, model, table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram = Unigram.of(model)
        for batch in slices(batches, "text"):
            raw, starts, ends, rows, hashes = _words(batch.column("text"))
            tokens, scores = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
            at = np.searchsorted(known, hashes)
            at[at == len(known)] = 0
            hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
            tokens[hit], scores[hit] = known_tokens[at[hit]], known_scores[at[hit]]
            miss = np.flatnonzero(~hit)
            _, first, back = np.unique(hashes[miss], return_index=True, return_inverse=True)
            words = _cut_out(raw, starts[miss[first]], ends[miss[first]])
            order = sorted(range(len(words)), key=words.__getitem__)
            t, s = unigram.learn(SPACE + words[i] for i in order)
            new_tokens, new_scores = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            new_tokens[order], new_scores[order] = t, _fixed(s)
            tokens[miss], scores[miss] = new_tokens[back], new_scores[back]
            bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[bounds]) for x in (tokens, scores)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(sums[0]), pa.array(sums[1] / FIXED)],
                names=["doc_id", "n_words", "n_tokens", "log_prob"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long, log_prob double")
