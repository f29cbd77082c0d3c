"""Keys dealt once with their lines, and sizes and sketches in front of the texts."""

import random

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from scorewright.llm import line_dedup
from scorewright.llm.editjoin import LineKeys, may_be_alike, pairs_alike, sketches

sets = st.lists(st.sets(st.integers(0, 40), max_size=30), min_size=1, max_size=10)


def _row(line, n, sketch, key=1, lo=0, hi=0, c=0):
    return {"line": line, "own": True, "key": key, "lo": lo, "hi": hi, "c": c, "n": n, "sketch": sketch.tobytes()}


@settings(deadline=None)
@given(sets)
def test_no_like_pair_is_ruled_out(some):
    names = np.random.default_rng(3).integers(0, 1 << 63, 41).astype(np.uint64)
    arrays = [np.sort(names[list(s)]) if s else np.zeros(0, np.uint64) for s in some]
    size, n = np.array([len(a) for a in arrays]), len(some)
    marks = sketches(np.repeat(np.arange(n), size), np.concatenate(arrays), n)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n)))
    assert not (pairs_alike(arrays, a, b) & ~may_be_alike(size, marks, a, b)).any()


def test_lines_with_one_phrase_in_common_go_no_further():
    rng = random.Random(8)
    phrase = "in no event shall the authors"
    for count in (3, 40):  # compared pair by pair, and as a block
        base = [" ".join([phrase, *(f"w{rng.randrange(10 ** 6)}" for _ in range(60))]) for _ in range(count)]
        lines = [*base, base[1].replace(" w", " x", 1)]
        owner, runs = LineKeys(lines).shingles()
        n, marks = np.bincount(owner, minlength=len(lines)), sketches(owner, runs, len(lines))
        for keys in ((1,), (1, 3)):  # near copies meet in many keys and are one task
            rows = pd.DataFrame([_row(k, n[k], marks[k], key) for key in keys for k in range(len(lines))])
            assert sorted(line_dedup._hopeful(rows)["line"]) == [1, count]


def test_chunks_of_a_key_meet_across_only():
    owner, runs = LineKeys([" ".join(f"w{k}" for k in range(50))]).shingles()
    mark = sketches(owner, runs, 1)[0]
    rows = pd.DataFrame([_row(k, len(runs), mark, hi=1, c=k % 2) for k in range(20)])
    out = line_dedup._hopeful(rows)  # many pairs: the lines stay as they are
    assert sorted(out["line"]) == list(range(20)) and set(out["key"]) == {1} and (out["c"] == out["line"] % 2).all()
    assert line_dedup._hopeful(rows[rows["c"] == 0].reset_index(drop=True)).empty


def test_a_bucket_holds_all_lines_of_a_key(spark):
    docs = [(i, f"line number {i} of some that begin differently {'abc'[i % 3]} but end alike") for i in range(40)]
    texts = line_dedup._texts(spark.createDataFrame(docs, "doc_id long, text string")).repartition(4)
    packed = line_dedup._packed(texts, 20, 2, 7).collect()
    pairs = [(r.bucket, k, i) for r in packed for k, i in np.frombuffer(r.pairs, np.uint64).reshape(-1, 2).tolist()]
    keys = sorted(r.key for r in line_dedup._keys(texts, 20, 2).collect())
    plain = np.array([k & ~3 | k >> 1 & 1 for _, k, _ in pairs], np.uint64).view(np.int64)
    assert sorted(plain.tolist()) == sorted(k & ~2 for k in keys)
    where = {}
    for bucket, k, _ in pairs:
        assert where.setdefault(k >> 2, bucket) == bucket
    met = line_dedup._meetings(texts, 20, 2)
    rows = met.collect()
    assert len({(r.key, r.line) for r in rows}) == len(rows)
    assert {r.line for r in rows} == {line_dedup._ids(t)[0] & ~1 for _, t in docs}
