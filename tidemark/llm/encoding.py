"""Token ids of whole texts with a tokenizers file, for tasks.

`WordEncoder` gives exactly the ids of `Tokenizer.encode(text,
add_special_tokens=False)`. Where the file drops white space and splits words
from punctuation by the pattern below, a text's ids are the ids of its
space-separated chunks one after the other, so chunks are encoded once and
remembered in a table of bounded size. Of those, words of letters, which are
nearly all and mostly rare, get the file's merges many at a time (`WordMerges`);
the library does the rest. Any other file is used text by text.
"""

from __future__ import annotations

import json
import os
import re
from unicodedata import is_normalized

import numpy as np

#: Chunks remembered by a worker at most; the table starts anew when full.
CACHE_CHUNKS = 500_000
#: Longer chunks are encoded each time.
CACHE_CHARS = 64
# Fixed value: the word pattern for which chunks are independent.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# A small letter before a mark (the few letters that lose that place in lower case are no small letters).
_JOINT = re.compile(r"(?<=[a-z\u00df-\u00f6\u00f8-\u00ff])(?=[!-/:-@\[-`{-~])")
_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a file; it outlives the task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class WordEncoder:
    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        pre = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.by_chunk = (
            pre.get("type") == "Split" and pre.get("pattern") == {"Regex": WORD_PATTERN}
            and pre.get("behavior") == "Removed" and pre.get("invert") is True and not parts.get("post_processor")
            and all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in parts.get("added_tokens", []))
        )
        self.special = [t["content"] for t in parts.get("added_tokens", [])]
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.cache_chunks = cache_chunks
        model = parts["model"]
        self.merges = None
        if self.by_chunk and model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges"):
            self.merges = WordMerges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self._known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self.by_chunk:
            return [_pack(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        if len(self._known) > self.cache_chunks:
            self._known = {}
        known, split = self._known, [self._chunks(t) for t in texts]
        missing = list(set().union(*split).difference(known))
        simple = [c for c in missing if c.isalpha() and len(c) <= CACHE_CHARS and c == c.lower() and is_normalized("NFC", c)]
        if self.merges is not None:
            known.update(zip(simple, self.merges.encode(simple), strict=True))
            missing = [c for c in missing if c not in known]
        for i in range(0, len(missing), 1000):
            part = missing[i : i + 1000]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            known.update((c, _pack(e.ids)) for c, e in zip(part, found, strict=True))
        out = [b"".join(map(known.__getitem__, chunks)) for chunks in split]
        for chunk in missing:
            if len(chunk) > CACHE_CHARS:
                del known[chunk]
        return out

    def _chunks(self, text: str) -> list[str]:
        """Parts of a text at whose joints no token can reach across: at spaces, and between a letter and a mark."""
        if any(s[0] in text for s in self.special):  # special tokens may hold such joints
            return text.replace("\n", " ").split(" ")
        if text.isascii():
            text = text.lower()
        return _JOINT.sub(" ", text.replace("\n", " ")).split(" ")


class WordMerges:
    """A file's merges applied to many words at once.

    Words of one byte length are the rows of a matrix of ids. Each step joins
    in every row the pair that comes first in the list of merges (the leftmost
    of equals), so rows stay of equal length and finished ones are taken out.
    """

    _SLOTS = 19

    def __init__(self, vocab: dict[str, int], merges: list, end: str) -> None:
        signs = _byte_signs()
        self.inner = np.array([vocab[c] for c in signs], np.int64)
        self.last = np.array([vocab[c + end] for c in signs], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.result = np.array([vocab[a + b] for a, b in pairs] + [0], np.int64)
        self.none = len(pairs)
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        self.keys = np.full(1 << self._SLOTS, -1, np.int64)
        self.ranks = np.full(1 << self._SLOTS, self.none, np.int32)
        slots = self._slot(keys)
        for rank, (slot, key) in enumerate(zip(slots.tolist(), keys.tolist(), strict=True)):
            while self.keys[slot] not in (-1, key):
                slot = (slot + 1) & ((1 << self._SLOTS) - 1)
            if self.keys[slot] == -1:
                self.keys[slot], self.ranks[slot] = key, rank

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._SLOTS)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 20 | right).ravel()
        slots = self._slot(keys)
        found = self.keys[slots]
        out = self.ranks[slots]
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            slots[todo] = (slots[todo] + 1) & ((1 << self._SLOTS) - 1)
            found = self.keys[slots[todo]]
            out[todo] = self.ranks[slots[todo]]
            todo = todo[(found != keys[todo]) & (found != -1)]
        return out.reshape(left.shape)

    def encode(self, words: list[str]) -> list[bytes]:
        data = [w.encode() for w in words]
        widths = np.array([len(d) for d in data])
        out: list[bytes] = [b""] * len(data)
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            symbols = np.frombuffer(b"".join(data[i] for i in rows.tolist()), np.uint8).reshape(-1, width)
            ids = self.inner[symbols]
            ids[:, -1] = self.last[symbols[:, -1]]
            self._merge(ids, rows, out)
        return out

    def _merge(self, ids: np.ndarray, rows: np.ndarray, out: list[bytes]) -> None:
        ranks = self._rank(ids[:, :-1], ids[:, 1:])
        while len(rows):
            width = ids.shape[1]
            best = ranks.argmin(1) if width > 1 else np.zeros(len(rows), np.int64)
            at = np.arange(len(rows))
            rank = ranks[at, best] if width > 1 else np.full(len(rows), self.none)
            done = rank == self.none
            if done.any():
                packed = ids[done].astype("<u4").tobytes()
                for k, row in enumerate(rows[done].tolist()):
                    out[row] = packed[k * 4 * width : (k + 1) * 4 * width]
                ids, ranks, rows, best, rank = ids[~done], ranks[~done], rows[~done], best[~done], rank[~done]
                at = np.arange(len(rows))
            if not len(rows):
                return
            columns = np.arange(width - 1)
            ids = np.take_along_axis(ids, columns + (columns > best[:, None]), 1)
            ids[at, best] = self.result[rank]
            ranks = np.take_along_axis(ranks, columns[:-1] + (columns[:-1] >= best[:, None]), 1)
            for shift in (-1, 0):  # the pairs that now touch the joined symbol
                left = best + shift
                has = np.flatnonzero((left >= 0) & (left < width - 2))
                ranks[has, left[has]] = self._rank(ids[has, left[has]], ids[has, left[has] + 1])


def _byte_signs() -> list[str]:
    """The printable sign that stands for each byte in byte-level files."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    kept = set(own)
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


def _pack(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()
