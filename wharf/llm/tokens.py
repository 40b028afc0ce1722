"""Token ids of whole texts with a public tokenizer file, cached by pre-token.

The file's tokenizer normalises (NFC, lower case), splits by pattern and runs byte-pair merges per
pre-token. Merges see one pre-token at a time, so their ids can be kept: texts made of plain Latin
characters are split here, each distinct pre-token is encoded once per Python worker, and texts with any
other character go through the tokenizer as they are. Both ways give the same ids (tested).
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

CACHE = 600_000  # distinct pre-tokens that a worker keeps, and
CACHE_CHARS = 32 << 20  # their characters; beyond either the cache starts anew


def _char_class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c)).startswith(kind))


_L, _N = _char_class("L"), _char_class("N")
# Fixed value: the pre-token pattern of the tokenizer file, for characters below U+0250.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
# Control characters that Python and the file's pattern may class differently are left to the tokenizer,
# as is everything beyond Latin (some capitals have their lower case there) and every text that may spell a
# special token.
_FAR_LOWER = "".join(chr(c) for c in range(0x250) if max(unicodedata.normalize("NFC", chr(c)).lower()) > chr(0x24F))
_OTHER = re.compile(f"[^\t-\r -~\xa0-ɉ]|[{_FAR_LOWER}]|<\\|")


class TokenIds:
    """Ids of texts; one per Python worker and file (``of``)."""

    _kept: dict[str, "TokenIds"] = {}

    @classmethod
    def of(cls, path: str) -> "TokenIds":
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def __init__(self, path: str) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_str(json.dumps(spec))
        self.whole.no_padding()
        self.whole.no_truncation()
        self.cached = False
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        if len(steps) == 2 and steps[1].get("type") == "ByteLevel" and [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            self.cached = True
            # the same merges for texts that are parted by spaces already
            split = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, steps[1]]}
            plain = dict(spec, normalizer=None, pre_tokenizer=split, added_tokens=[], post_processor=None)
            self.merges = Tokenizer.from_str(json.dumps(plain))
            suffix = spec["model"].get("end_of_word_suffix") or "</w>"
            vocab = spec["model"]["vocab"]
            self.last = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a pre-token
            self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self._clear()

    def _clear(self) -> None:
        self.codes: dict[str, int] = {}  # pre-token -> number of its ids' place
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 12, np.int64)
        self.used = self.chars = 0

    def _learn(self, new: list[str]) -> None:
        """Keep the ids of new pre-tokens, encoded together and parted at the ids that end one."""
        text = [" ".join(new[i : i + 512]) for i in range(0, len(new), 512)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.merges.encode_batch_fast(text, add_special_tokens=False)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(new):
            raise ValueError("the tokenizer file does not mark the ends of pre-tokens")
        count = len(self.codes)
        while count + len(new) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.ends[count + 1 : count + 1 + len(new)] = self.used + ends
        self.used += len(ids)
        self.chars += sum(map(len, new))
        self.codes.update(zip(new, range(count, count + len(new))))

    def ids(self, text: str | None) -> np.ndarray:
        """uint32 ids without special tokens; null counts as empty."""
        if not text:
            return np.zeros(0, np.uint32)
        if not self.cached or _OTHER.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        # per-character lower case equals str.lower for what is left below U+0250
        parts = _SPLIT.findall(unicodedata.normalize("NFC", text).lower())
        if not parts:
            return np.zeros(0, np.uint32)
        if len(self.codes) > CACHE or self.chars > CACHE_CHARS:
            self._clear()
        got = list(map(self.codes.get, parts))
        if None in got:
            self._learn(list({p for p, c in zip(parts, got) if c is None}))
            got = list(map(self.codes.__getitem__, parts))
        code = np.array(got, np.int64)
        starts = self.ends[code]
        sizes = self.ends[code + 1] - starts
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]
