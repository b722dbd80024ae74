"""A generalised suffix automaton over word numbers."""

from __future__ import annotations

from collections.abc import Sequence


class SuffixAutomaton:
    """Recognises every run of words that occurs in one of a list of items.

    ``window`` words are one window of an item; an item with fewer words is one window
    as a whole. After ``add`` of all items, ``finish`` computes for each state which
    items hold its window and which short items end there.
    """

    def __init__(self, window: int) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.items: list[tuple[list[str], Sequence[int]]] = []

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(-1)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The part of state ``q`` that ``p`` reaches by ``word``, as a state of its own."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1)
        self.next[clone] = dict(self.next[q])
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return self._split(last, word, q)
        new = self._state(self.length[last] + 1)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        self.link[new] = 0 if p < 0 else self._split(p, word, self.next[p][word])
        return new

    def add(self, ids: list[str], words: Sequence[int]) -> None:
        """One text, and the ids of the items that have it."""
        if not words:
            return
        self.items.append((ids, words))
        state = 0
        for word in words:
            state = self._extend(state, word)

    def finish(self) -> SuffixAutomaton:
        n, window = len(self.length), self.window
        held: list[set[int] | None] = [None] * n
        short: dict[int, list[int]] = {}
        seen = [-1] * n
        for number, (_, words) in enumerate(self.items):
            state = 0
            for word in words:
                state = self.next[state][word]
                up = state
                while up > 0 and self.length[up] >= window and seen[up] != number:
                    seen[up] = number
                    held[up] = (held[up] or set()) | {number}
                    up = self.link[up]
            if len(words) < window:
                while self.length[self.link[state]] >= len(words):
                    state = self.link[state]
                short.setdefault(state, []).append(number)
        self.held = held
        # the state on the way up whose shortest run still has a window's length
        self.top = [0] * n
        # the short items that end at a state or on the way up, as (length, item)
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * n
        for state in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[state]
            if self.length[state] >= window:
                self.top[state] = self.top[up] or state
            own = tuple((len(self.items[i][1]), i) for i in short.get(state, ()))
            self.ending[state] = own + self.ending[up]
        return self

    def scan(self, words: list[int], hit: bytearray, offset: int, found: set[int]) -> int:
        """Marks the hit words in ``hit`` from ``offset`` on and adds the items found.

        Returns the longest run of words that some item holds.
        """
        nexts, link, length, window = self.next, self.link, self.length, self.window
        ending, top, held = self.ending, self.top, self.held
        state = matched = longest = 0
        for i, word in enumerate(words):
            while state and word not in nexts[state]:
                state = link[state]
                matched = length[state]
            state = nexts[state].get(word, 0)
            matched = matched + 1 if state else 0
            if matched > longest:
                longest = matched
            if matched >= window:
                hit[offset + i - window + 1 : offset + i + 1] = b"\1" * window
                found |= held[top[state]]
            for size, item in ending[state]:
                if size <= matched:
                    hit[offset + i - size + 1 : offset + i + 1] = b"\1" * size
                    found.add(item)
        return longest
