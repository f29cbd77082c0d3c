"""Wu-Manber search for many byte strings (numpy, for use inside tasks).

A text is cut into lanes that move on together: each lane reads the block that ends its current window, the shift
table says how far the lane can move without missing a string, and only a shift of zero leads to the bucket of strings
that have this block as the suffix of their first ``m`` bytes.  Those are compared directly: first by prefix, then whole.
"""

from __future__ import annotations

import numpy as np

LANE = 2048
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _blocks(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """``width`` (at most 8) bytes from each position, as integers; ``data`` has 8 spare bytes at its end."""
    rows = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    x = np.ascontiguousarray(rows[at]).view(np.uint64).ravel()
    return x if width == 8 else x & np.uint64((1 << 8 * width) - 1)


class _Tables:
    """Shift and suffix tables of strings that all have at least ``m`` bytes."""

    def __init__(self, numbers: list[int], patterns: list[bytes], m: int):
        self.m, self.width = m, min(8, m)
        self.longest = max(len(patterns[i]) for i in numbers)
        spare = b"\0" * 8
        joined = np.frombuffer(b"".join(patterns[i][:m] for i in numbers) + spare, np.uint8)
        starts = np.arange(len(numbers)) * m
        places = m - self.width + 1
        self.bits = max(12, min(24, int(np.ceil(np.log2(len(numbers) * places * 16)))))
        self.shift = np.full(1 << self.bits, places, np.int32)
        for j in range(places):
            np.minimum.at(self.shift, self._hash(_blocks(joined, starts + j, self.width)), places - 1 - j)
        suffix = self._hash(_blocks(joined, starts + places - 1, self.width))
        order = np.argsort(suffix, kind="stable")
        self.numbers = np.asarray(numbers)[order]
        self.keys, self.first, self.count = np.unique(suffix[order], return_index=True, return_counts=True)
        self.prefix_width = min(8, m)
        self.prefix = _blocks(joined, starts, self.prefix_width)[order]

    def _hash(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((x * _MUL) >> np.uint64(64 - self.bits)).astype(np.int64)

    def candidates(self, data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and string numbers where suffix block and prefix agree."""
        at = np.arange(0, max(0, length - self.m + 1), LANE)
        end = np.minimum(at + LANE, length - self.m + 1)
        back = self.m - self.width
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        while len(at):
            h = self._hash(_blocks(data, at + back, self.width))
            s = self.shift[h]
            hit = s == 0
            if hit.any():
                pos = at[hit]
                k = np.searchsorted(self.keys, h[hit])
                n = self.count[k]
                which = np.repeat(self.first[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pos = np.repeat(pos, n)
                same = _blocks(data, pos, self.prefix_width) == self.prefix[which]
                found.append((pos[same], self.numbers[which[same]]))
            at = at + np.maximum(s, 1)
            on = at < end
            at, end = at[on], end[on]
        return tuple(np.concatenate(x) for x in zip(*found))


class WuManber:
    """All occurrences of ``patterns`` (distinct, not empty).  Strings are kept in classes of similar length, since the
    shortest string of a table bounds every shift."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        classes: dict[int, list[int]] = {}
        for i, p in enumerate(patterns):
            classes.setdefault(0 if len(p) < 8 else 1 if len(p) < 24 else 2, []).append(i)
        self.tables = [_Tables(ids, patterns, min(len(patterns[i]) for i in ids)) for ids in classes.values()]

    def search(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Position and string number of each occurrence, in no order."""
        data = np.frombuffer(text + b"\0" * 8, np.uint8)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for t in self.tables:
            pos, which = t.candidates(data, len(text))
            if t.longest > t.prefix_width:
                same = [text.startswith(self.patterns[i], p) for p, i in zip(pos.tolist(), which.tolist())]
                same = np.array(same, bool)
                pos, which = pos[same], which[same]
            found.append((pos, which))
        return tuple(np.concatenate(x) for x in zip(*found))
