"""Signature tree over shingle sets: a join inside one group of candidates.

Leaves hold up to ``LEAF`` sets, inner nodes up to ``FANOUT`` children.  A node
keeps the OR of its sets' bitmaps, its range of sizes, and the largest number
of tokens that share a bit within one set (``clash``).  Two sets x, y share at
most ``|B(x) & B(y)| + min(clash(x), clash(y))`` tokens, and so do any two sets
of two nodes by the nodes' bitmaps; a node pair is pruned when even that is
below what its smallest sizes need, or when the size ranges are too far apart.
A pair whose sets all hang together already is skipped: it can't change the
classes.
"""

from __future__ import annotations

import numpy as np

LEAF = 16
FANOUT = 8


def popcount(words: np.ndarray) -> np.ndarray:
    """Number of set bits along the last axis of uint64 words."""
    return np.bitwise_count(words).sum(axis=-1, dtype=np.int64)


def needed(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of sets of sizes x and y with 100 * overlap >= percent * union."""
    return -(-percent * (x + y) // (100 + percent))


def bitmaps(sets: list[np.ndarray], n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(bitmap of each set, tokens in excess of its bits)."""
    out = np.zeros((len(sets), n_words), dtype=np.uint64)
    for row, tokens in zip(out, sets, strict=True):
        bit = tokens & np.uint64(n_words * 64 - 1)
        np.bitwise_or.at(row, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out, np.array([len(s) for s in sets]) - popcount(out)


class _Forest:
    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)


def _levels(n: int) -> list[list[tuple[int, int]]]:
    """Ranges of sets by tree level, leaves first."""
    levels = [[(i, min(i + LEAF, n)) for i in range(0, n, LEAF)]]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([(below[i][0], below[min(i + FANOUT, len(below)) - 1][1]) for i in range(0, len(below), FANOUT)])
    return levels


def classes(sets: list[np.ndarray], percent: int, only_across: np.ndarray | None = None) -> np.ndarray:
    """Smallest index of each set's class under links of Jaccard >= ``percent``.

    ``sets``: sorted distinct uint64 tokens, none empty.  ``only_across``: side
    (0 or 1) of each set; pairs of one side are then taken as known already.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    # alike sets next to each other: by size, then by their smallest tokens
    order = sorted(range(n), key=lambda i: (size[i].item().bit_length(), tuple(sets[i][:4].tolist())))
    sets, size = [sets[i] for i in order], size[order]
    side = None if only_across is None else only_across[order]
    bits = 1 << int(np.clip(8 * int(size.max()), 256, 1 << 16) - 1).bit_length()
    maps, clash = bitmaps(sets, bits // 64)
    forest = _Forest(n)
    levels = _levels(n)
    nodes = [[(a, b, np.bitwise_or.reduce(maps[a:b]), int(size[a:b].min()), int(size[a:b].max()),
               int(clash[a:b].max())) for a, b in level] for level in levels]

    def prunable(p: tuple, q: tuple) -> bool:
        if 100 * p[4] < percent * q[3] or 100 * q[4] < percent * p[3]:
            return True
        bound = int(popcount(p[2] & q[2])) + min(p[5], q[5])
        return bound < int(needed(np.int64(p[3]), np.int64(q[3]), percent))

    def joined(p: tuple, q: tuple) -> bool:
        root = forest.root(p[0])
        return all(forest.root(i) == root for i in range(p[0], p[1])) and (
            p is q or all(forest.root(i) == root for i in range(q[0], q[1])))

    def compare(p: tuple, q: tuple) -> None:
        for i in range(p[0], p[1]):
            first = max(i + 1, q[0])
            if first >= q[1]:
                continue
            j = np.arange(first, q[1])
            least = needed(size[i], size[j], percent)
            able = (popcount(maps[j] & maps[i]) + np.minimum(clash[j], clash[i]) >= least) & (
                100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
            if side is not None:
                able &= side[j] != side[i]
            for k, enough in zip(j[able].tolist(), least[able].tolist(), strict=True):
                if forest.root(i) != forest.root(k) and \
                        np.isin(sets[k], sets[i], assume_unique=True, kind="sort").sum() >= enough:
                    forest.join(i, k)

    stack = [(len(levels) - 1, 0, 0)]
    while stack:
        level, a, b = stack.pop()
        p, q = nodes[level][a], nodes[level][b]
        if (a != b and prunable(p, q)) or joined(p, q):
            continue
        if level == 0:
            compare(p, q)
            continue
        lower = len(nodes[level - 1])
        children = [range(x * FANOUT, min((x + 1) * FANOUT, lower)) for x in (a, b)]
        # the nearest pairs last, so that they are taken first and join most
        pairs = [(level - 1, x, y) for x in children[0] for y in children[1] if x <= y]
        stack.extend(sorted(pairs, key=lambda t: t[1] - t[2]))
    smallest: dict[int, int] = {}
    for i in range(n):
        root = forest.root(i)
        smallest[root] = min(smallest.get(root, n), order[i])
    out = np.empty(n, dtype=np.int64)
    for i in range(n):
        out[order[i]] = smallest[forest.root(i)]
    return out
