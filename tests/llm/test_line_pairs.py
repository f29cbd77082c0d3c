"""Comparison of many pairs of lines at once, against one pair at a time."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from scorewright.llm.editjoin import alike, pairs_alike, pairs_within, small_pairs, within

groups = st.lists(st.integers(1, 6), max_size=8).map(lambda n: np.repeat(np.arange(len(n)), n))
sets = st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=20), min_size=1, max_size=12)
lines = st.lists(st.text("ab", max_size=8), min_size=1, max_size=10)


@settings(deadline=None)
@given(groups, st.integers(1, 5))
def test_pairs_of_small_groups(group, few):
    a, b = small_pairs(group, few)
    n = np.bincount(group) if len(group) else []
    want = {(i, j) for i in range(len(group)) for j in range(i + 1, len(group)) if group[i] == group[j] and n[group[i]] <= few}
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(want)


def component(links, n):
    root = list(range(n))
    for a, b in links:
        x, y = root[a], root[b]
        root = [x if r == y else r for r in root]
    return [root.index(r) for r in root]


@settings(deadline=None)
@given(sets, st.integers(1, 60))
def test_like_sets(some, cells):
    arrays = [np.array(sorted(s), np.uint64) for s in some]
    n = len(some)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n)))
    near = [5 * len(some[x] & some[y]) >= 4 * len(some[x] | some[y]) for x, y in zip(a, b)]
    assert pairs_alike(arrays, a, b, block=7).tolist() == near
    query = np.arange(n) % 2 == 0
    for q, i in ((np.ones(n, bool), np.ones(n, bool)), (query, ~query)):
        want = [(x, y) for x, y, ok in zip(a.tolist(), b.tolist(), near) if ok and q[x] and i[y]]
        got = alike(arrays, q, i, cells=cells)
        assert set(got) <= set(want) and component(got, n) == component(want, n)


@settings(deadline=None)
@given(lines, st.integers(1, 3))
def test_close_lines(some, most):
    n = len(some)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n)))
    assert pairs_within(some, a, b, most).tolist() == [within(some[x], some[y], most) for x, y in zip(a, b)]
    assert pairs_within(some, a[:0], b[:0], most).tolist() == []
