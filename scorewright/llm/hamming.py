"""Gray-order hierarchical index over 64-bit fingerprints (numpy, for use inside tasks).

The fingerprints of a bucket are sorted by Gray rank, so that neighbours share most bits.  Runs of ``FAN`` neighbours
form a node; a node keeps the bits that all its members share (mask and value), each child only those shared bits its
parent does not hold already.  The differences of a query on the masks of a path add up to a lower bound for every
fingerprint below, so one comparison prunes or accepts a whole group.
"""

from __future__ import annotations

import numpy as np

from .common import popcount

FAN = 8
FRONTIER = 4_000_000


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each value in the reflected Gray sequence."""
    r = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


class Level:
    __slots__ = ("mask", "value", "own", "free", "first", "child", "children", "last")


class GrayForest:
    """One tree per bucket; ``bucket`` holds dense numbers 0..n-1, in any order."""

    def __init__(self, bucket: np.ndarray, values: np.ndarray):
        self.order = np.lexsort((gray_rank(values), bucket))
        b, v = bucket[self.order], values[self.order]
        leaf = Level()
        leaf.mask, leaf.value = np.full(len(v), np.uint64(0xFFFFFFFFFFFFFFFF)), v
        leaf.first = np.arange(len(v))
        leaf.last = leaf.first
        leaf.child = leaf.children = None
        self.levels, self.bucket = [leaf], [b]
        while True:
            b, low = self.bucket[-1], self.levels[-1]
            starts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
            if len(starts) == len(b):
                break
            within = np.arange(len(b)) - np.repeat(starts, np.diff(np.r_[starts, len(b)]))
            cut = np.flatnonzero(within % FAN == 0)
            size = np.diff(np.r_[cut, len(b)])
            up = Level()
            up.value = low.value[cut]
            differ = np.bitwise_or.reduceat(low.value ^ np.repeat(up.value, size), cut)
            up.mask = np.bitwise_and.reduceat(low.mask, cut) & ~differ
            up.child, up.children = cut, size
            up.first, up.last = low.first[cut], low.last[cut + size - 1]
            low.own = low.mask & ~np.repeat(up.mask, size)
            self.levels.append(up)
            self.bucket.append(b[cut])
        top = self.levels[-1]
        top.own = top.mask
        for level in self.levels:
            level.free = 64 - popcount(level.mask)
        self.root = {"bucket": self.bucket[-1]}

    def links(self, bucket: np.ndarray, queries: np.ndarray, most: int, rank: np.ndarray | None = None):
        """Pairs (query number, leaf number in sorted order) that connect each query with all fingerprints of its
        bucket within ``most`` bits, up to links between neighbours inside an accepted group.  ``rank``: the sorted
        place of a query that is itself in the index; then only groups that reach behind it are visited."""
        at = np.searchsorted(self.root["bucket"], bucket)
        ok = at < len(self.root["bucket"])
        ok[ok] = self.root["bucket"][at[ok]] == bucket[ok]
        todo = [np.flatnonzero(ok)]
        while todo:
            q = todo.pop()
            if len(q) > 32768:
                todo += [q[i:i + 32768] for i in range(0, len(q), 32768)]
                continue
            yield from self._descend(q, at, queries, most, rank, todo)

    def _descend(self, q, root, queries, most, rank, todo):
        node = root[q]
        whole = q
        depth = len(self.levels) - 1
        level = self.levels[depth]
        acc = popcount((queries[q] ^ level.value[node]) & level.own[node])
        found = []
        while True:
            keep = acc <= most
            if rank is not None:
                keep &= level.last[node] > rank[q]
            q, node, acc = q[keep], node[keep], acc[keep]
            if not len(q):
                break
            taken = acc + level.free[node] <= most
            if taken.any():
                found.append((q[taken], level.first[node[taken]]))
                q, node, acc = q[~taken], node[~taken], acc[~taken]
            if depth == 0 or not len(q):
                break
            size = level.children[node]
            if size.sum() > FRONTIER and len(whole) > 1:  # bounded memory: the same queries again, in halves
                half = len(whole) // 2
                todo += [whole[:half], whole[half:]]
                return
            start = np.repeat(level.child[node], size)
            step = np.arange(len(start)) - np.repeat(np.cumsum(size) - size, size)
            q, acc, node = np.repeat(q, size), np.repeat(acc, size), start + step
            depth -= 1
            level = self.levels[depth]
            acc = acc + popcount((queries[q] ^ level.value[node]) & level.own[node])
        yield from found

    def neighbours(self, most: int):
        """Pairs of neighbouring leaves of one bucket within ``most`` bits."""
        b, v = self.bucket[0], self.levels[0].value
        near = np.flatnonzero((b[1:] == b[:-1]) & (popcount(v[1:] ^ v[:-1]) <= most))
        return near, near + 1


def star(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number reachable from each of 0..n-1 over the pairs (a, b)."""
    least = np.arange(n)
    while len(a):
        low = np.minimum(least[a], least[b])
        np.minimum.at(least, least[a], low)
        np.minimum.at(least, least[b], low)
        while True:
            jump = least[least]
            if (jump == least).all():
                break
            least = jump
        open_ = least[a] != least[b]
        a, b = a[open_], b[open_]
    return least


def bucket_links(bucket: np.ndarray, values: np.ndarray, query: np.ndarray, index: np.ndarray, most: int):
    """Links (value, value) that connect, in each bucket, all query rows with all index rows within ``most`` bits.

    A bucket either has all rows on both sides or disjoint sides.  Returns a forest (at most one link a row)."""
    if not len(values):
        return values, values
    _, bucket = np.unique(bucket, return_inverse=True)
    rows = np.flatnonzero(index)
    forest = GrayForest(bucket[rows], values[rows])
    place = rows[forest.order]
    a, b = forest.neighbours(most)
    ends = [(place[a], place[b])]
    both = query & index
    rank = np.full(len(values), -1)
    rank[place] = np.arange(len(place))
    for mine in (np.flatnonzero(both), np.flatnonzero(query & ~index)):
        if len(mine):
            own = rank[mine] if both[mine[0]] else None
            for q, leaf in forest.links(bucket[mine], values[mine], most, own):
                ends.append((mine[q], place[leaf]))
    a, b = (np.concatenate(x) for x in zip(*ends))
    least = star(len(values), a, b)
    moved = np.flatnonzero(least != np.arange(len(least)))
    return values[moved], values[least[moved]]
