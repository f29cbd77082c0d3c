"""An indexable skip list over the token boundaries of a text (for use inside tasks).

Boundary k lies behind the first k tokens.  Lane 0 links every boundary to the next one; a boundary is also on lane j if
its height, drawn from a hash of its rank, is above j.  A link carries two widths: how many tokens it passes, and how many
code points.  The lanes of one text are numpy arrays, each made from the lane below it."""

from __future__ import annotations

import numpy as np

#: Heights use two bits of the hash a lane: each lane holds about a quarter of the boundaries of the one below.
LANE_BITS, MAX_LANES = 2, 24


def heights(n: int) -> np.ndarray:
    """Lanes above lane 0 that each of the boundaries 0 to ``n`` reaches; boundary 0, the head, is on all of them."""
    x = np.arange(n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    low = x & (~x + np.uint64(1))  # the lowest set bit
    zeros = np.bitwise_count(low - np.uint64(1))
    high = np.minimum(zeros // LANE_BITS, MAX_LANES).astype(np.int64)
    high[0] = MAX_LANES
    return high


class SkipList:
    """Lanes over tokens of the given ``sizes`` (code points)."""

    def __init__(self, sizes: np.ndarray):
        n = len(sizes)
        high = heights(n)
        #: per lane: units and code points of the link that starts at each of its boundaries, and that boundary's place one lane down
        self.units, self.points, self.down = [np.ones(n, np.int64)], [np.asarray(sizes, np.int64)], [np.arange(n + 1)]
        lane, on = 0, np.arange(n + 1)
        while True:
            lane += 1
            here = np.flatnonzero(high[on] >= lane)
            if len(here) < 2:
                break
            # the links of the lane below between two boundaries of this lane make one link here
            last = here[-1]
            self.units.append(np.add.reduceat(self.units[-1][:last], here[:-1]))
            self.points.append(np.add.reduceat(self.points[-1][:last], here[:-1]))
            self.down.append(here)
            on = on[here]

    def point(self, rank: int) -> int:
        """Code points before boundary ``rank``: lane by lane downwards, as far as the widths passed stay within the rank."""
        units = points = at = 0
        for lane in range(len(self.units) - 1, -1, -1):
            wide, long = self.units[lane], self.points[lane]
            while at < len(wide) and units + wide[at] <= rank:
                units += int(wide[at])
                points += int(long[at])
                at += 1
            at = int(self.down[lane][at])
        if units != rank:
            raise IndexError(rank)
        return points
