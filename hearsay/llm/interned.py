"""Arrays of numbers for strings, computed once for each distinct string while they fit.

Texts repeat their words, so what a word becomes is kept by the worker process and gathered by numpy for
whole batches. Words that came first are kept for good, since frequent words come early; the others are
forgotten when the store is full. Results don't depend on what is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np


class _Places(dict):
    """The place of each word; a new word gets the next one."""

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        return place


class Interned:
    """``compute`` maps strings to their lists of ids; at most some ``limit`` ids and characters are kept."""

    def __init__(self, compute: Callable[[list[str]], Sequence[Sequence[int]]], limit: int = 3_000_000):
        self.compute, self.limit = compute, limit
        self.places, self.held, self.first, self.first_ids = _Places(), 0, 0, 0
        self.begins, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _forget(self) -> None:
        """Keeps the words that filled the first half."""
        words = list(self.places)[: self.first]
        self.places = _Places(zip(words, range(self.first)))
        self.begins, self.sizes = self.begins[: self.first].copy(), self.sizes[: self.first].copy()
        self.ids, self.held = self.ids[: self.first_ids].copy(), self.limit // 2

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``words`` in a row, and the number of ids of each word."""
        if self.held > self.limit:
            self._forget()
        known = len(self.places)
        at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        if len(self.places) > known:
            new = list(self.places)[known:]
            found = self.compute(new)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.begins = np.append(self.begins, len(self.ids) + np.cumsum(sizes) - sizes)
            self.sizes = np.append(self.sizes, sizes)
            self.ids = np.append(self.ids, np.fromiter((i for f in found for i in f), np.int32, int(sizes.sum())))
            self.held += int(sizes.sum()) + sum(map(len, new))
            if self.held <= self.limit // 2:
                self.first, self.first_ids = len(self.places), len(self.ids)
        sizes = self.sizes[at]
        return self.ids[spread(self.begins[at], sizes)], sizes


def spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions begin, begin + 1, ... of each run, one run after the other."""
    total = int(sizes.sum())
    return np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum over each run of ``sizes`` values; runs may be empty."""
    total = np.append(0, np.cumsum(values))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]
