"""Texts to ids with a word-level memory, shared by the token operators.

A text is cut at ASCII white space, across which no piece of the vocabulary
reaches; every different word is encoded once and the ids of a whole batch
of texts are gathered with numpy.  The memory lives as long as the Python
worker and is emptied when it holds ``KEEP`` words, so it stays bounded.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from itertools import chain

import numpy as np

KEEP = 300_000


class _Codes(dict):
    """Numbers words in order of appearance."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, word):
        self[word] = n = len(self)
        self.new.append(word)
        return n


class WordMemory:
    """``encode`` maps a list of new words (bytes) to a list of id lists."""

    def __init__(self, encode: Callable[[list], list], keep: int = KEEP):
        self.encode, self.keep = encode, keep
        self._clear()

    def _clear(self):
        self.codes = _Codes()
        self.ids = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)

    def _learn(self) -> None:
        rows = self.encode(self.codes.new)
        size = np.fromiter(map(len, rows), np.int32, len(rows))
        flat = np.fromiter(chain.from_iterable(rows), np.int32, int(size.sum()))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size, dtype=np.int64) - size])
        self.ids = np.concatenate([self.ids, flat])
        self.size = np.concatenate([self.size, size])
        self.codes.new = []

    def batch(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and each text's number."""
        if len(self.codes) > self.keep:
            self._clear()
        lists = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
        n_words = np.fromiter(map(len, lists), np.int64, len(lists))
        get = self.codes.__getitem__
        code = np.fromiter(map(get, chain.from_iterable(lists)), np.int32, int(n_words.sum()))
        if self.codes.new:
            self._learn()
        size = self.size[code].astype(np.int64)
        end = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[code] - end[:-1], size)
        at += np.arange(len(at))
        return self.ids[at], np.diff(end[np.concatenate([[0], np.cumsum(n_words)])])


def kept(name: str, make: Callable):
    """``make()`` once per Python worker and name: the functions of this
    package travel by value, so their own globals do not outlive a task."""
    store = sys.modules.setdefault("_marquee_kept", types.ModuleType("_marquee_kept"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)
