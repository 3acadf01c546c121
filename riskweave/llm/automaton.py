"""A suffix automaton over word sequences."""

from __future__ import annotations


class SuffixAutomaton:
    """All word runs of the added texts; for each, the smallest document that holds it."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [2**63 - 1]

    def _state(self, length: int, following: dict[str, int], link: int, first: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.first.append(first)
        return len(self.next) - 1

    def add(self, words: list[str], document: int) -> None:
        """Texts in any order; runs never reach from one text into another."""
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for w in words:
            if w in nxt[last]:  # another text began alike
                q = nxt[last][w]
                if length[q] != length[last] + 1:
                    q = self._split(last, q, w)
                last = q
                self.first[q] = min(self.first[q], document)
                continue
            new, p = self._state(length[last] + 1, {}, 0, document), last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, q, w)
            last = new

    def _split(self, p: int, q: int, w: str) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], 2**63 - 1)
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def finish(self) -> None:
        """Hands every state's smallest document on to its suffixes."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up = self.link[s]
            self.first[up] = min(self.first[up], self.first[s])

    def holders(self, words: list[str], width: int) -> list[int | None]:
        """Matching statistics of ``words`` at ``width``: for every run of that many words the
        smallest document that holds it, or None."""
        nxt, link, length = self.next, self.link, self.length
        out, state, matched = [], 0, 0
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state, matched = nxt[state][w], matched + 1
            while state and length[link[state]] >= width:  # shortest state that still has `width` words
                state = link[state]
                matched = length[state]
            if i >= width - 1:
                out.append(self.first[state] if matched >= width else None)
        return out
