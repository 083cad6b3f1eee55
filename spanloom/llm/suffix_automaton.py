"""A generalised suffix automaton over sequences of integers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """Grows by whole sequences; states are parallel lists."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def add(self, sequence: Iterable[int]) -> list[int]:
        """Inserts a sequence.  For each position: the longest suffix of the sequence up to there that
        occurred before, in an earlier sequence or at an earlier place of this one."""
        nxt, link, length = self.next, self.link, self.length
        last, out = 0, []
        for c in sequence:
            q = nxt[last].get(c)
            if q is not None:  # the whole prefix is known
                if length[q] != length[last] + 1:
                    q = self._split(last, c, q)
                last = q
                out.append(length[q])
                continue
            cur = self._state(length[last] + 1, 0, {})
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = cur
            out.append(length[link[cur]])
        return out

    def _split(self, p: int, c: int, q: int) -> int:
        nxt, link = self.next, self.link
        clone = self._state(self.length[p] + 1, link[q], dict(nxt[q]))
        link[q] = clone
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def matching_statistics(self, sequence: Sequence[int]) -> list[int]:
        """For each position, the longest suffix ending there that occurs in what was added."""
        nxt, link, length = self.next, self.link, self.length
        state, n, out = 0, 0, []
        for c in sequence:
            while state and c not in nxt[state]:
                state = link[state]
                n = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                n += 1
            out.append(n)
        return out
