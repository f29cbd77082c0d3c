import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scorewright.llm.fill_middle import ADDED, fill_in_middle, restore, token_sizes
from scorewright.llm.queries import QUERIES
from scorewright.llm.skiplist import SkipList, heights

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    """The contract's row, by slicing a list of tokens."""
    text = text or ""
    w = TOKEN.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(w) + 1), h2 % (len(w) + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(w), "plain", None, None, text
    if h4 % 100 < 80:
        return len(w), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(w), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.text("ab é\n\t\x0b\u2003😀", max_size=80))
def test_tokens_and_ranks(text):
    w = TOKEN.findall(text)
    assert token_sizes(text).tolist() == [len(x) for x in w]
    lanes = SkipList(token_sizes(text))
    assert [lanes.point(k) for k in range(len(w) + 1)] == [len("".join(w[:k])) for k in range(len(w) + 1)]


def test_lanes_thin_out():
    sizes = np.random.default_rng(1).integers(1, 9, 100_000)
    lanes = SkipList(sizes)
    assert 6 <= len(lanes.units) <= 24
    for wide, long in zip(lanes.units, lanes.points):
        assert wide.sum() <= len(sizes) and long.sum() == sizes[:wide.sum()].sum()
    assert all(len(b) < len(a) for a, b in zip(lanes.units, lanes.units[1:]))
    for k in (0, 1, 77_777, 100_000):
        assert lanes.point(k) == sizes[:k].sum()
    with pytest.raises(IndexError):
        lanes.point(100_001)
    assert (heights(9) == heights(9)).all()


def cases():
    rng = random.Random(4)
    parts = ["a", "bé", "😀", " ", "\n", "\t ", "<", "<P", "S>", "<S", "M>", "<P>"]
    weights = [9, 9, 3, 9, 4, 3, 2, 1, 1, 1, 1, 0.1]
    return [(i, "".join(rng.choices(parts, weights, k=rng.randrange(0, 60)))) for i in range(600)]


def test_equals_brute_force(spark):
    docs = cases()
    out = fill_in_middle(spark.createDataFrame(docs, "doc_id long, text string")).withColumn("again", restore_column())
    rows = {r.doc_id: r for r in out.collect()}
    for i, t in docs:
        r = rows[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(i, t)
        assert r.text == t and r.again == t
    assert {r.form for r in rows.values()} == {"plain", "psm", "spm"}


def restore_column():
    from pyspark.sql import functions as F
    return restore(F.col("form"), F.col("output"))


def test_edges(spark, edge_docs, edge_rows, no_docs):
    docs = edge_docs.withColumnRenamed("hits", "output").withColumnRenamed("gone", "form").withColumnRenamed("fp", "missing")
    out = fill_in_middle(docs)
    assert out.columns == [c for c in docs.columns if c not in ADDED] + list(ADDED)
    rows = out.collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, r.text) for r in rows), key=key) == sorted(((i, t) for i, t, *_ in edge_rows), key=key)
    assert all((r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text) for r in rows)
    assert all(r.row == "extra-row" and r.missing == "extra-fp" for r in rows)
    assert fill_in_middle(no_docs).collect() == []


def test_query_round_trip(spark, as_table, folder):
    docs = [*cases()[:80], (900, None), (901, ""), (902, "   "), (903, "one")]
    as_table(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = QUERIES["op13_fill_middle"](spark, folder).collect()
    digest = {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in docs}
    assert len(rows) == len(docs) and all(r.restored_sha256 == digest[r.doc_id] for r in rows)
