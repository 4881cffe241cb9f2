"""Generalised suffix automaton over word sequences, with an exact block prefilter.

The automaton holds every substring of a stated set of texts (benchmark items, licence templates).
Streaming a document's words through it yields, at each word, the longest suffix that occurs in the
set (matching statistics). A text of at least ``window`` words reports its windows; a shorter one
reports only its whole sequence. Once built, states and transitions are flat arrays: about thirty bytes
a word, which is what a broadcast of a block carries.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

import numpy as np


class SuffixAutomaton:
    def __init__(self, window: int, min_match: int | None = None):
        self.window = window
        self.min_match = min_match or window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self._texts: list[tuple[object, list[int]]] = []

    @classmethod
    def build(cls, texts: Iterable[tuple[object, Sequence[bytes]]], window: int, min_match: int | None = None):
        auto = cls(window, min_match)
        for key, words in texts:
            if words:
                auto._add(key, [auto.vocab.setdefault(w, len(auto.vocab)) for w in words])
        auto._finish()
        return auto

    def _new(self, length: int, like: int | None = None) -> int:
        self.next.append({} if like is None else dict(self.next[like]))
        self.link.append(-1 if like is None else self.link[like])
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """Clone q at length(p)+1 and redirect p's suffix chain to the clone."""
        clone = self._new(self.length[p] + 1, q)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _add(self, key: object, ids: list[int]) -> None:
        self._texts.append((key, ids))
        last = 0
        for c in ids:
            q = self.next[last].get(c)
            if q is not None:  # the prefix already occurs in an earlier text
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
                continue
            cur, p = self._new(self.length[last] + 1), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = self.link[p]
            if p < 0:
                self.link[cur] = 0
            else:
                q = self.next[p][c]
                self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
            last = cur

    def _finish(self) -> None:
        nxt = self.next
        self.first, self.label, self.target = array("i", [0]), array("i"), array("i")
        for held in nxt:
            for c in sorted(held):
                self.label.append(c)
                self.target.append(held[c])
            self.first.append(len(self.label))
        self.next = []
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        w = self.window
        #: the suffix-chain state that holds the suffix of exactly ``window`` words
        self.holder = array("i", bytes(4 * len(self.link)))
        for s in order:
            if self.length[s] >= w:
                up = self.link[s]
                self.holder[s] = s if self.length[up] < w else self.holder[up]
        windows: dict[int, set] = {}
        whole: dict[int, list] = {}
        pairs: set[tuple[int, int]] = set()
        ends: set[int] = set()
        self.keys = sorted({key for key, _ in self._texts}, key=lambda k: (k is None, str(k)))
        number = {key: i for i, key in enumerate(self.keys)}
        for key, ids in self._texts:
            pairs.update(zip(ids, ids[1:]))
            s = 0
            for i, c in enumerate(ids, 1):
                s = nxt[s][c]
                if i >= w and len(ids) >= w:
                    windows.setdefault(self.holder[s], set()).add(number[key])
            if len(ids) < w:
                whole.setdefault(s, []).append((len(ids), key))
                ends.add(ids[-1])
        #: numbers of the keys whose window a state is, by state
        self.window_first, self.window_keys = array("i", [0]), array("i")
        for s in range(len(self.link)):
            self.window_keys.extend(sorted(windows.get(s, ())))
            self.window_first.append(len(self.window_keys))
        #: per state: its own short texts, and the nearest suffix state that has any
        self.whole = whole
        self.whole_up = array("i", bytes(4 * len(self.link)))
        for s in order:
            up = self.link[s]
            self.whole_up[s] = up if up in whole else self.whole_up[up] if up > 0 else 0
        self.link, self.length = array("i", self.link), array("i", self.length)
        self._texts = []
        bits = max(16, (16 * len(pairs) + 1).bit_length())
        self._mask = (1 << bits) - 1
        self._pair = np.zeros(1 << bits, dtype=bool)
        if pairs:
            a, b = np.array(sorted(pairs), dtype=np.int64).T
            self._pair[self._slot(a, b)] = True
        self._end = np.zeros(len(self.vocab) + 1, dtype=bool)
        self._end[list(ends)] = True

    def step(self, s: int, c: int) -> int:
        """The state after word ``c``, or -1."""
        a, b = self.first[s], self.first[s + 1]
        if b - a > 1:
            a = bisect_left(self.label, c, a, b)
        return self.target[a] if a < b and self.label[a] == c else -1

    def window_of(self, state: int) -> list:
        """Keys of the texts with the window that ends here."""
        h = self.holder[state]
        return [self.keys[i] for i in self.window_keys[self.window_first[h] : self.window_first[h + 1]]]

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a * 0x9E3779B1) ^ (b * 0x85EBCA77) ^ ((a * 0x9E3779B1) >> 15)) & self._mask

    def encode(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocab.get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Stretches [a, b) outside which no match of ``min_match`` words and no short text can lie.

        A match needs all its neighbouring word pairs in the set, so this drops only text that
        streaming would report as too short; a pair-table collision merely lengthens a stretch.
        """
        known = ids >= 0
        if not known.any():
            return []
        joined = known[:-1] & known[1:]
        at = np.flatnonzero(joined)
        joined[at] = self._pair[self._slot(ids[at], ids[at + 1])]
        first = known.copy()
        first[1:] &= ~joined
        last = known.copy()
        last[:-1] &= ~joined
        a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
        keep = b - a >= self.min_match
        if self._end.any():
            marks = np.concatenate(([0], np.cumsum(self._end[ids])))  # id -1 reads the spare last slot
            keep |= marks[b] > marks[a]
        return list(zip(a[keep].tolist(), b[keep].tolist()))

    def stream(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """(state, matched length) after each word."""
        step, link, length = self.step, self.link, self.length
        s = n = 0
        for c in ids:
            t = step(s, c)
            while t < 0 and s:
                s = link[s]
                n = length[s]
                t = step(s, c)
            if t < 0:
                s = n = 0
            else:
                s, n = t, n + 1
            yield s, n

    def shorts(self, state: int, n: int) -> Iterator[tuple[int, object]]:
        """(length, key) of the short texts that end here."""
        s = state
        while s > 0:
            for size, key in self.whole.get(s, ()):
                if size <= n:
                    yield size, key
            s = self.whole_up[s]
