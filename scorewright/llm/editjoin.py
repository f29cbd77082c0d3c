"""Partition-based edit join: segments, length-aware probes and bit-parallel verification (for use inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

#: Word shingles: words in one, words of a line that has them, and the share that like lines have in common.
RUN, MIN_WORDS, ALIKE = 5, 20, (4, 5)
#: Bits that stand for all shingles of a line.
SKETCH = 256


def cuts(length: int, parts: int) -> list[int]:
    return [length * i // parts for i in range(parts + 1)]


def probes(length: int, most: int) -> list[tuple[int, int, int, int, bool]]:
    """(indexed length, segment, from, to, own) of the substrings that a line of ``length`` looks up; those marked
    ``own`` are its segments, which it also puts into the index.

    A line within ``most`` edits of one not longer than itself has one of that line's ``most`` + 1 segments unchanged,
    shifted by no more than what the edits before it and after it allow."""
    parts, out = most + 1, []
    for size in range(max(parts, length - most), length + 1):
        at, more = cuts(size, parts), length - size
        for i in range(parts):
            left, right = i, most - i
            lo = max(0, at[i] - left, at[i] + more - right)
            hi = min(length - (at[i + 1] - at[i]), at[i] + left, at[i] + more + right)
            for p in range(lo, hi + 1):
                out.append((size, i, p, p + at[i + 1] - at[i], size == length and p == at[i]))
    return out


def segment_keys(line: str, plan: list[tuple[int, int, int, int, bool]]) -> list[int]:
    """One 64-bit key for each entry of ``plan``; equal for equal (length, segment number, characters)."""
    wide = line.encode("utf-32-le", "surrogatepass")
    key = xxhash.xxh3_64_intdigest
    return [key(wide[4 * a:4 * b], size * 16 + i) for size, i, a, b, _ in plan]


_BASE, _ODD, _STEP = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Code points at which ``str.split`` separates words.
SPACE = np.zeros(0x3001, bool)
SPACE[[c for c in range(0x3001) if chr(c).isspace()]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD
    x = (x ^ (x >> np.uint64(27))) * _STEP
    return x ^ (x >> np.uint64(31))


#: A value for each code point.
_VALUE = _mixed(np.arange(1, 0x110001, dtype=np.uint64))
#: Powers of ``_BASE`` and of its inverse, as many as the longest text so far needed.
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: So many lowest bits a shingle's key leaves to a line's number, so that one plain sort puts both in order.
_LOW = 16


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            more = np.full(1 << n.bit_length(), base, np.uint64)
            more[0] = 1
            _POWERS[k] = np.cumprod(more)
    return _POWERS


class LineKeys:
    """Keys of many lines at once: any run of characters of a line is hashed from one running sum over all lines."""

    def __init__(self, lines: list[str]):
        self.sizes = np.array([len(x) for x in lines], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(self.points)
        power, self.back = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[self.points] * power[:n], out=self.sums[1:])

    def runs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hashes of the characters from place ``a`` to ``b`` of the joined lines."""
        return (self.sums[b] - self.sums[a]) * self.back[a]

    def segments(self, plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line number, key, own) of every segment and probe; ``plan`` gives the ``probes`` of a length as an array."""
        kinds, kind = np.unique(self.sizes, return_inverse=True)
        plans = [plan(n) for n in kinds.tolist()]
        many = np.array([len(p) for p in plans], np.int64)
        times = many[kind]
        which = np.repeat(np.arange(len(kind)), times)
        entry = np.arange(len(which)) + np.repeat((np.cumsum(many) - many)[kind] - (np.cumsum(times) - times), times)
        size, i, a, b, own = np.concatenate([*plans, np.zeros((0, 5), np.int64)]).T
        start = self.starts[which]
        salt = (size * 16 + i).astype(np.uint64) * _STEP
        return which, _mixed(self.runs(start + a[entry], start + b[entry]) + salt[entry]), (own == 1)[entry]

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """(line number, key) of the different runs of ``RUN`` words of every line of ``MIN_WORDS`` words or more, in order."""
        blank = SPACE[self.points] if self.points.max(initial=0) <= 0x3000 else SPACE[np.minimum(self.points, 0x3000)] & (self.points <= 0x3000)
        first = np.zeros(len(blank) + 1, bool)
        first[self.starts[self.sizes > 0]] = True
        begin, end = ~blank, ~blank
        begin[1:] &= blank[:-1] | first[1:-1]
        end[:-1] &= blank[1:] | first[1:-1]
        begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        line = np.searchsorted(self.starts + self.sizes, begin, "right")
        long = np.bincount(line, minlength=len(self.sizes)) >= MIN_WORDS
        some = long[line]
        begin, end, line = begin[some], end[some], line[some]
        words = _mixed(self.runs(begin, end))
        n = max(len(line) - RUN + 1, 0)
        key = np.zeros(n, np.uint64)
        for k in range(RUN):
            key = key * _ODD + words[k:k + n]
        at = np.flatnonzero(line[:n] == line[RUN - 1:])
        owner, key, out = line[at], _mixed(key[at]) >> np.uint64(_LOW), []
        names = np.flatnonzero(long)
        for k in range(0, len(names), 1 << _LOW):  # a key has 64 - _LOW bits, the number of its line the others
            here = names[k:k + (1 << _LOW)]
            lo, hi = np.searchsorted(owner, [here[0], here[-1] + 1])
            both = np.sort(np.searchsorted(here, owner[lo:hi]).astype(np.uint64) << np.uint64(64 - _LOW) | key[lo:hi])
            both = both[np.r_[True, both[1:] != both[:-1]][:len(both)]]
            out.append((here[both >> np.uint64(64 - _LOW)], both << np.uint64(_LOW)))
        none = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        return tuple(np.concatenate(x) for x in zip(*(out or none)))

    def least_shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """The least of each line's n shingles, so many that lines with ``ALIKE`` of theirs in common share one of these."""
        owner, key = self.shingles()
        n = np.bincount(owner, minlength=len(self.sizes))
        rank = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
        few = rank < (n - -(-n * ALIKE[0] // ALIKE[1]) + 1)[owner]
        return owner[few], key[few]


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most ``most``: a band of 2 * ``most`` + 1 diagonals as one word, column by column."""
    d = len(a) - len(b)
    if abs(d) > most:
        return False
    lo, hi = 0, min(len(a), len(b))
    while lo < hi and a[lo] == b[lo]:
        lo += 1
    tail = 0
    while tail < hi - lo and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[lo:len(a) - tail], b[lo:len(b) - tail]
    if not a or not b:
        return True
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << 2 * most + 1) - 1
    up, down = full >> most << most, 0  # vertical steps of +1 and -1 in the band
    end, distance = d + most, max(d, 0)  # the diagonal that ends at the last characters
    for j, c in enumerate(b, 1):
        at = j - most - 1
        same = places.get(c, 0)
        same = (same >> at if at >= 0 else same << -at) & full
        flat = (((same & up) + up) ^ up | same | down) & full
        distance += not flat >> end & 1
        if distance > most:
            return False
        plus, minus = (down | ~(flat | up)) & full, flat & up
        flat >>= 1
        up, down = (minus | ~(flat | plus)) & full, flat & plus
    return True


def letter_counts(lines: list[str], width: int = 32) -> np.ndarray:
    """Characters of each line counted by code point modulo ``width``; an edit changes the counts by at most 2."""
    return np.array([np.bincount(np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) % width, minlength=width)
                     for x in lines], np.int32).reshape(-1, width)


def small_pairs(group: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places in the same group, for the groups of at most ``few`` members; ``group`` ascends."""
    at = np.flatnonzero(np.bincount(group)[group] <= few) if len(group) else np.zeros(0, np.int64)
    both = [(at[:-d], at[d:]) for d in range(1, min(few, len(at)))]
    both = [(x[same], y[same]) for x, y in both for same in [group[x] == group[y]]]
    return tuple(np.concatenate([np.zeros(0, np.int64), *side]) for side in (zip(*both) if both else ((), ())))


def pairs_alike(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, block: int = 1 << 13) -> np.ndarray:
    """Whether the sets of shingles at ``a`` and at ``b`` have a Jaccard similarity of ``ALIKE`` at least."""
    size = np.array([len(x) for x in sets], np.int64)
    out = np.minimum(size[a], size[b]) * ALIKE[1] >= ALIKE[0] * np.maximum(size[a], size[b])
    names, code = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)
    begin = np.cumsum(size) - size
    every = np.repeat(np.arange(len(sets)), size) * len(names) + code
    left = np.flatnonzero(out)
    for k in range(0, len(left), block):
        some = left[k:k + block]
        x, y = a[some], b[some]
        which = np.repeat(np.arange(len(some)), size[x])
        place = np.arange(len(which)) - np.repeat(np.cumsum(size[x]) - size[x], size[x]) + begin[x][which]
        want = y[which] * len(names) + code[place]
        spot = np.minimum(np.searchsorted(every, want), len(every) - 1)
        both = np.bincount(which, every[spot] == want, len(some))
        out[some] = both * ALIKE[1] >= ALIKE[0] * (size[x] + size[y] - both)
    return out


def sketches(owner: np.ndarray, runs: np.ndarray, n: int) -> np.ndarray:
    """``SKETCH`` bits for each of ``n`` lines: one is set if an odd number of the line's shingles fall on it.  A shingle
    that only one of two lines has changes one bit, so two sketches differ in no more bits than the sets in shingles."""
    bit = (runs >> np.uint64(_LOW)) % np.uint64(SKETCH)
    odd = np.bincount(owner * SKETCH + bit.astype(np.int64), minlength=n * SKETCH) & 1
    return np.packbits(odd.reshape(n, SKETCH).astype(np.uint8), axis=1).view(np.uint64)


def may_be_alike(size: np.ndarray, marks: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether lines at ``a`` and ``b`` may have the share ``ALIKE`` of shingles in common: of the shingles of both, in all
    (``ALIKE`` as p of q) no more than q - p in q + p are then without a partner."""
    both, out = (size[a] + size[b]) * (ALIKE[1] - ALIKE[0]), np.abs(size[a] - size[b]) * (ALIKE[1] + ALIKE[0])
    out = out <= both
    left = np.flatnonzero(out)
    apart = np.bitwise_count(marks[a[left]] ^ marks[b[left]]).sum(1, dtype=np.int64)
    out[left] = apart * (ALIKE[1] + ALIKE[0]) <= both[left]
    return out


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A key for each pair of line ids."""
    return _mixed(_mixed(a.astype(np.int64).view(np.uint64)) * _ODD + b.astype(np.int64).view(np.uint64))


def pairs_within(lines: list[str], a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Whether the lines at ``a`` and at ``b`` are within ``most`` edits."""
    size = np.array([len(x) for x in lines], np.int64)
    out = np.abs(size[a] - size[b]) <= most
    some, at = np.unique(np.r_[a[out], b[out]], return_inverse=True)
    counts = letter_counts([lines[k] for k in some.tolist()])
    left, right = at.reshape(2, -1)
    out[out] = np.abs(counts[left] - counts[right]).sum(1) <= 2 * most
    for k in np.flatnonzero(out).tolist():
        out[k] = within(lines[a[k]], lines[b[k]], most)
    return out


def alike(sets: list[np.ndarray], query: np.ndarray, index: np.ndarray, cells: int = 1 << 22) -> list[tuple[int, int]]:
    """Links that connect query lines with index lines whose sets of shingles have a Jaccard similarity of ``ALIKE`` at
    least, none between lines already connected.  Only shingles of two lines or more can be in common; what each
    pair shares is a product of matrices, of so many queries at a time that a matrix has ``cells`` cells at most or one row."""
    size = np.array([len(x) for x in sets], np.int64)
    names, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared, owner = times[code] > 1, np.repeat(np.arange(len(sets)), size)
    column = (np.cumsum(times > 1) - 1)[code[shared]]
    width = int((times > 1).sum())
    begin = np.searchsorted(owner[shared], np.arange(len(sets) + 1))
    root, out = np.arange(len(sets)), []
    asked = np.flatnonzero(query)
    step = max(1, cells // max(1, width))
    for k in range(0, len(asked), step):
        some = asked[k:k + step]
        table = np.zeros((len(some), max(1, width)), np.float32)
        for row, q in enumerate(some.tolist()):
            table[row, column[begin[q]:begin[q + 1]]] = 1
        both = np.zeros((len(some), len(sets)), np.int64)
        for r in range(0, len(sets), step):
            part = slice(begin[r], begin[min(r + step, len(sets))])
            other = np.zeros((min(step, len(sets) - r), max(1, width)), np.float32)
            other[owner[shared][part] - r, column[part]] = 1
            both[:, r:r + step] = table @ other.T
        near = index & (both * ALIKE[1] >= ALIKE[0] * (size[some][:, None] + size - both))
        for row, q in enumerate(some.tolist()):
            for r in np.flatnonzero(near[row] & (root != root[q])).tolist():
                if root[r] != root[q]:
                    root[root == root[r]] = root[q]
                    out.append((q, r))
    return out


def linked(lines: list[str], query: np.ndarray, index: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that connect query lines with index lines within ``most`` edits; pairs already connected are not compared."""
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    counts, size, out = letter_counts(lines), np.array([len(x) for x in lines]), []
    rows = np.flatnonzero(index)
    for q in np.flatnonzero(query):
        near = rows[(np.abs(size[rows] - size[q]) <= most)]
        near = near[np.abs(counts[near] - counts[q]).sum(1) <= 2 * most]
        for r in near.tolist():
            if (r < q or not query[r] or not index[q]) and r != q:
                a, b = find(q), find(r)
                if a != b and within(lines[q], lines[r], most):
                    root[a] = b
                    out.append((int(q), r))
    return out
