"""Hierarchical index over 64-bit fingerprints in Gray order, searched against itself.

The fingerprints of a unit are sorted by their rank in the reflected Gray code,
so neighbours in the order share many bits.  Each upper node covers ``FAN``
neighbours and keeps the bits that all of them share (mask and pattern).  A
search walks pairs of nodes from the roots down, adds up the differences in the
bits that become known at each level, and drops a pair of whole groups as soon
as the sum exceeds the limit.  Many units are walked at once as arrays.
"""

from __future__ import annotations

import numpy as np

#: Children of an upper node, and pairs of nodes held at once.
FAN, PAIRS_AT_ONCE = 8, 1_000_000


def roots_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links (i, j): the smallest node of each one's component."""
    at = np.arange(n)
    while True:
        a, b = at[i], at[j]
        if np.array_equal(a, b):
            return at
        np.minimum.at(at, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(at, at[at]):
            at = at[at]


class Level:
    """One level of the index: per node its first child, number of children, shared-bit mask and pattern."""

    def __init__(self, first: np.ndarray, count: np.ndarray, mask: np.ndarray, pattern: np.ndarray, unit_start: np.ndarray):
        self.first, self.count, self.mask, self.pattern, self.unit_start = first, count, mask, pattern, unit_start


def build(fp: np.ndarray, starts: np.ndarray) -> list[Level]:
    """Levels from the leaves up; ``starts``: each unit's first row in ``fp`` (Gray order within the unit)."""
    full = np.full(len(fp), np.uint64(0xFFFFFFFFFFFFFFFF))
    levels = [Level(np.arange(len(fp)), np.zeros(len(fp), np.int64), full, fp, starts)]
    sizes = np.diff(np.append(starts, len(fp)))
    while len(levels) == 1 or sizes.max() > 1:
        below = levels[-1]
        parents = -(-sizes // FAN)
        up = np.concatenate([[0], np.cumsum(parents)[:-1]])
        which = np.arange(parents.sum()) - np.repeat(up, parents)
        first = np.repeat(below.unit_start, parents) + which * FAN
        count = np.minimum(FAN, np.repeat(sizes, parents) - which * FAN)
        ones = np.bitwise_and.reduceat(below.pattern & below.mask, first)
        zeros = np.bitwise_and.reduceat(~below.pattern & below.mask, first)
        levels.append(Level(first, count, ones | zeros, ones, up))
        sizes = parents
    return levels


def close_pairs(fp: np.ndarray, starts: np.ndarray, most: int):
    """Yields arrays (i, j) of the rows within ``most`` bits of each other in a unit, each pair once."""
    levels = build(fp, starts)
    top = levels[-1].unit_start
    zero = np.zeros(len(top), np.int64)
    stack = [(len(levels) - 1, top, top, zero, np.zeros(len(top), np.uint64))]
    while stack:
        at, a, b, differ, known = stack.pop()
        if at == 0:
            yield a, b
            continue
        here, below = levels[at], levels[at - 1]
        if (here.count[a] * here.count[b]).sum() > PAIRS_AT_ONCE and len(a) > 1:
            h = len(a) // 2
            stack += [(at, a[:h], b[:h], differ[:h], known[:h]), (at, a[h:], b[h:], differ[h:], known[h:])]
            continue
        n = here.count[a] * here.count[b]
        pair = np.repeat(np.arange(len(a)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = here.count[b][pair]
        x, y = here.first[a][pair] + k // wide, here.first[b][pair] + k % wide
        keep = (x < y) | ((x == y) & (at > 1))
        pair, x, y = pair[keep], x[keep], y[keep]
        shared = below.mask[x] & below.mask[y]
        new = shared & ~known[pair]
        total = differ[pair] + np.bitwise_count((below.pattern[x] ^ below.pattern[y]) & new)
        keep = total <= most
        stack.append((at - 1, x[keep], y[keep], total[keep], shared[keep]))


def spanning_links(fp: np.ndarray, starts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are linked in their unit, each with the first row of its component (no pair lists)."""
    at = np.arange(len(fp))
    for i, j in close_pairs(fp, starts, most):
        if len(i):
            at = roots_of(len(fp), np.concatenate([np.arange(len(fp)), i]), np.concatenate([at, j]))
    moved = np.flatnonzero(at != np.arange(len(fp)))
    return moved, at[moved]
