"""Token ids of many texts by the tokenizers library, each distinct piece of text between spaces encoded once.

The vocabulary's rules never join anything across white space, so a text's ids are those of its runs of other
characters, one after another. A worker keeps the ids of runs that it has met in flat arrays, found by a 64-bit hash;
when `ENTRIES` are reached it starts anew. The library encodes what is new, many runs in one call.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from riskmart.llm import words

DEFAULT = "word_bpe_49k.json"
ENTRIES = 1 << 20
_BITS = 21  # of the slots: twice ENTRIES
_MARK = "\x01"  # a character that is one token of its own between spaces

_encoders: dict[str, "Encoder"] = {}


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(DEFAULT)


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.mark = self.library.encode(_MARK, add_special_tokens=False).ids
        self._clear()

    def _clear(self, n: int = 0) -> None:
        """An empty table, at most half full with `n` keys."""
        self.bits = max(_BITS, (2 * n - 1).bit_length()) if n else _BITS
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.begin = np.zeros(1 << self.bits, np.int64)
        self.count = np.zeros(1 << self.bits, np.int32)
        self.ids = np.zeros(1 << 20, np.uint32)
        self.n_ids = self.n_keys = 0

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text in them); `end` is appended to every text."""
        found = words.find(texts)
        keys = np.maximum(found.hashes, np.uint64(1))
        slots = self._find(keys)
        if (slots < 0).any():
            slots = self._learn(found, keys, slots)
        lengths = self.count[slots].astype(np.int64)
        stops = np.cumsum(lengths)
        places = np.arange(stops[-1] if len(stops) else 0) + np.repeat(self.begin[slots] - (stops - lengths), lengths)
        ids = self.ids[places]
        bounds = np.concatenate([[0], stops])[found.bounds]
        if end is not None:
            ids = np.insert(ids, bounds[1:], end)
            bounds = bounds + np.arange(len(bounds))
        return ids, bounds

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where unknown."""
        slots = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        result = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            there = self.keys[slots[open_]]
            hit = there == keys[open_]
            result[open_[hit]] = slots[open_[hit]]
            open_ = open_[~hit & (there != 0)]
            slots[open_] = (slots[open_] + 1) % len(self.keys)
        return result

    def _learn(self, found: words.Words, keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
        new, at = np.unique(keys[slots < 0], return_index=True)
        if self.n_keys + len(new) > ENTRIES:
            new, at = np.unique(keys, return_index=True)
            self._clear(len(new))  # a long text may have more distinct runs than ENTRIES
        else:
            at = np.flatnonzero(slots < 0)[at]
        for begin in range(0, len(new), ENTRIES // 2):
            part = slice(begin, begin + ENTRIES // 2)
            self._store(new[part], [found.word(i).decode() for i in at[part].tolist()])
        return self._find(keys)

    def _store(self, keys: np.ndarray, runs: list[str]) -> None:
        ids, counts = self._encode_runs(runs)
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.n_ids:self.n_ids + len(ids)] = ids
        begins = self.n_ids + np.cumsum(counts) - counts
        self.n_ids += len(ids)
        self.n_keys += len(keys)
        slots, open_ = (keys >> np.uint64(64 - self.bits)).astype(np.int64), np.arange(len(keys))
        while len(open_):
            free = open_[self.keys[slots[open_]] == 0]
            _, first = np.unique(slots[free], return_index=True)
            put = free[first]
            self.keys[slots[put]], self.begin[slots[put]], self.count[slots[put]] = keys[put], begins[put], counts[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            open_ = open_[left[open_]]
            slots[open_] = (slots[open_] + 1) % len(self.keys)

    def _encode_runs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs one after another, and how many each has."""
        ids, counts = [], []
        for begin in range(0, len(runs), 1000):
            part = runs[begin:begin + 1000]
            joined = np.array(self._ids(f" {_MARK} ".join(part)), np.uint32)
            marks = np.flatnonzero(joined == self.mark[0]) if len(self.mark) == 1 else np.zeros(0, np.int64)
            if len(marks) == len(part) - 1:
                counts.append(np.diff(np.concatenate([[-1], marks, [len(joined)]])) - 1)
                ids.append(np.delete(joined, marks))
            else:  # a run holds the mark itself
                each = [self._ids(run) for run in part]
                counts.append(np.array([len(x) for x in each]))
                ids.append(np.array([i for x in each for i in x], np.uint32))
        return np.concatenate(ids), np.concatenate(counts).astype(np.int64)

    def _ids(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids
