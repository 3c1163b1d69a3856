"""Deep-shallow sorting of byte strings: multikey quicksort to a shallow depth, then blind tries.

Strings that still agree at the shallow depth share a long prefix; a blind trie orders them with one comparison of
whole strings each, however long the prefix is.
"""

from __future__ import annotations

SHALLOW, WORD, FEW = 32, 8, 4


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """Inner nodes are [depth, {byte or -1: child}], leaves lists of equal strings' numbers."""

    def __init__(self, strings: list[bytes]):
        self.s, self.root = strings, None

    @staticmethod
    def _at(s: bytes, d: int) -> int:
        return s[d] if d < len(s) else -1

    def insert(self, i: int) -> None:
        s = self.s[i]
        if self.root is None:
            self.root = (0, [i])
            return
        node = self.root
        while isinstance(node[1], dict):  # blindly: only branching bytes are looked at
            node = node[1].get(self._at(s, node[0])) or next(iter(node[1].values()))
        other = self.s[node[1][0]]
        d = common(s, other)
        if d == len(s) == len(other):
            node[1].append(i)
            return
        above, node = None, self.root
        while isinstance(node[1], dict) and node[0] < d:
            above, node = node, node[1][self._at(s, node[0])]
        if isinstance(node[1], dict) and node[0] == d:
            node[1][self._at(s, d)] = (0, [i])
            return
        split = (d, {self._at(other, d): node, self._at(s, d): (0, [i])})
        if above is None:
            self.root = split
        else:
            above[1][self._at(s, above[0])] = split

    def walk(self, order: list[int], lcp: list[int]) -> None:
        """Appends the numbers in order, and to lcp the common prefix with the one before (for the first: 0)."""
        stack, gap = [(self.root, 0)], 0
        while stack:
            (depth, kids), gap = stack.pop()
            if isinstance(kids, dict):
                stack += [(kids[c], depth) for c in sorted(kids, reverse=True)]
                stack[-1] = (stack[-1][0], gap)
            else:
                for n, i in enumerate(kids):
                    order.append(i)
                    lcp.append(gap if n == 0 else len(self.s[i]))


def sort_with_lcp(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """The order of the strings, and each one's common prefix with the one before it in that order."""
    order: list[int] = []
    lcp: list[int] = []
    todo = [(list(range(len(strings))), 0)]
    while todo:
        part, d = todo.pop()
        if len(part) > FEW and d < shallow:
            words = [strings[i][d : d + WORD] for i in part]
            pivot = sorted((words[0], words[len(words) // 2], words[-1]))[1]
            less = [i for i, w in zip(part, words) if w < pivot]
            same = [i for i, w in zip(part, words) if w == pivot]
            more = [i for i, w in zip(part, words) if w > pivot]
            todo += [x for x in ((more, d), (same, d + WORD if len(pivot) == WORD else shallow), (less, d)) if x[0]]
            continue
        trie = BlindTrie(strings)
        for i in part:
            trie.insert(i)
        last, n = (order[-1] if order else None), len(order)
        trie.walk(order, lcp)
        lcp[n] = 0 if last is None else common(strings[last], strings[order[n]])
    return order, lcp
