"""A bounded cache of the token ids of words, kept in flat arrays."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from itertools import repeat

import numpy as np


class IdCache:
    """Ids of word lists through the ids of each distinct word.

    ``learn`` maps a list of new words to their ids, one array in a row, and the
    number of ids of each word.  When the cache would
    hold over ``max_words`` words it starts anew, so memory stays bounded and
    results never depend on what it holds.
    """

    def __init__(self, learn: Callable[[list], tuple[np.ndarray, np.ndarray]], max_words: int = 500_000):
        self.learn, self.max_words = learn, max_words
        self._clear()

    def _clear(self) -> None:
        self.code: dict[Hashable, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 15, np.int64)
        self.words, self.used = 0, 0

    def _add(self, words: list) -> None:
        flat, sizes = self.learn(words)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.words + len(words) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.start[self.words + 1 : self.words + 1 + len(words)] = self.used + np.cumsum(sizes)
        self.code.update(zip(words, range(self.words, self.words + len(words)), strict=True))
        self.words, self.used = self.words + len(words), self.used + len(flat)

    def ids_of(self, words: list, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``words[use[0]], words[use[1]], ...`` in a row, and the number of each one's; ``words`` are distinct."""
        if self.words + len(words) > self.max_words and self.words + sum(w not in self.code for w in words) > self.max_words:
            self._clear()
        new = [w for w in words if w not in self.code]
        if new:
            self._add(new)
        codes = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))[use]
        begin = self.start[codes]
        size = self.start[codes + 1] - begin
        place = np.repeat(begin - np.cumsum(size) + size, size)
        return self.ids[place + np.arange(len(place))], size

    def _codes(self, words: list) -> np.ndarray:
        """The number of each word, -1 for new ones: one lookup a word."""
        return np.fromiter(map(self.code.get, words, repeat(-1)), np.int64, len(words))

    def encode(self, texts: list[list]) -> list[np.ndarray]:
        """Ids of each text, given as its list of words."""
        found = [self._codes(words) for words in texts]
        new = {words[i] for words, codes in zip(texts, found, strict=True) for i in (codes < 0).nonzero()[0].tolist()}
        if self.words + len(new) > self.max_words:
            self._clear()
            new = set().union(*texts)
            found = [np.full(len(words), -1) for words in texts]
        if new:
            self._add(sorted(new))
        out = []
        for words, codes in zip(texts, found, strict=True):
            late = (codes < 0).nonzero()[0].tolist() if new else []
            if late:
                codes[late] = [self.code[words[i]] for i in late]
            begin = self.start[codes]
            size = self.start[codes + 1] - begin
            ends = np.cumsum(size)
            place = np.repeat(begin - ends + size, size)
            out.append(self.ids[place + np.arange(len(place))])
        return out
