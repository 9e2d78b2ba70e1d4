"""A signature tree over a block of sets, and its dual traversal for similar pairs."""

from __future__ import annotations

import numpy as np

FANOUT = 8
#: 64-bit words compared at once in a traversal step.
STEP_WORDS = 1 << 20


def required(a, b, num: int = 80, den: int = 100):
    """Smallest overlap at which sets of sizes a and b reach similarity num/den: ceil(num (a+b) / (num+den))."""
    return -((-num * (a + b)) // (num + den))


class SignatureTree:
    """Nodes hold the OR of their sets' token bitmaps, the range of set sizes, and the surplus.

    A set's surplus is its size less the bits it sets. An overlap cannot have more tokens than
    bits in common plus its own surplus, and that is at most either set's, so
    popcount(X & Y) + min(surplus X, surplus Y) bounds the overlap of any pair below X and Y.
    """

    def __init__(self, sets: list[np.ndarray], marked: np.ndarray):
        sizes = np.array([len(s) for s in sets], np.int64)
        words = max(4, 1 << max(0, int(4 * sizes.max() - 1).bit_length() - 6))
        bits = np.zeros((len(sets), words), np.uint64)
        for row, s in zip(bits, sets, strict=True):
            at = (s % np.uint64(64 * words)).astype(np.int64)
            np.bitwise_or.at(row, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        surplus = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, surplus, marked)]
        while len(self.levels[-1][0]) > 1:
            b, low, high, extra, mark = self.levels[-1]
            at = np.arange(0, len(b), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(extra, at), np.logical_or.reduceat(mark, at)))

    def possible(self, level: int, i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
        """Which node pairs may hold a pair of sets similar enough, one of them marked."""
        bits, low, high, surplus, mark = self.levels[level]
        keep = (mark[i] | mark[j]) & (den * high[i] >= num * low[j]) & (den * high[j] >= num * low[i])
        at = np.flatnonzero(keep)
        need = required(low[i[at]], low[j[at]], num, den) - np.minimum(surplus[i[at]], surplus[j[at]])
        step = max(1, STEP_WORDS // bits.shape[1])
        for k in range(0, len(at), step):
            part = at[k : k + step]
            common = np.bitwise_count(bits[i[part]] & bits[j[part]]).sum(axis=1, dtype=np.int64)
            keep[part] = common >= need[k : k + step]
        return keep


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def linking_pairs(sets: list[np.ndarray], labels: np.ndarray, marked: np.ndarray | None = None, num: int = 80, den: int = 100) -> list[tuple[int, int]]:
    """Pairs (positions) that join what can be joined: with ``labels``' groups they give the same components as all similar pairs.

    The tree is walked against itself from the roots; node pairs go when their bound is too low.
    At the leaves a pair is compared exactly, unless its ends are in one component already.
    ``marked``: only pairs with a marked end count. Sets must not be empty.
    """
    order = np.lexsort((np.array([len(s) for s in sets]), np.array([s[0] for s in sets])))
    sets = [sets[k] for k in order]
    mark = np.ones(len(sets), bool) if marked is None else marked[order]
    label = np.unique(labels[order], return_inverse=True)[1]
    tree, found = SignatureTree(sets, mark), []
    i = j = np.zeros(1, np.int64)
    for level in range(len(tree.levels) - 2, -1, -1):
        count = len(tree.levels[level][0])
        down = np.arange(FANOUT)
        ci = np.broadcast_to(i[:, None, None] * FANOUT + down[:, None], (len(i), FANOUT, FANOUT)).ravel()
        cj = np.broadcast_to(j[:, None, None] * FANOUT + down, (len(i), FANOUT, FANOUT)).ravel()
        inside = (ci < count) & (cj < count) & (ci <= cj if level else ci < cj)
        i, j = ci[inside], cj[inside]
        if level:
            keep = tree.possible(level, i, j, num, den)
            i, j = i[keep], j[keep]
    for k in range(0, len(i), 4096):
        a, b = i[k : k + 4096], j[k : k + 4096]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
        keep = tree.possible(0, a, b, num, den)
        for x, y in zip(a[keep].tolist(), b[keep].tolist(), strict=True):
            if label[x] != label[y] and overlap(sets[x], sets[y]) >= required(len(sets[x]), len(sets[y]), num, den):
                label[label == label[y]] = label[x]
                found.append((int(order[x]), int(order[y])))
    return found
