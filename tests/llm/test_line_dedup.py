import random

from hypothesis import given, settings
from hypothesis import strategies as st

from scorewright.llm.editjoin import LineKeys, linked, probes, segment_keys, within
from scorewright.llm.line_dedup import dedup_lines
import numpy as np


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        nxt = [i + 1]
        for j, y in enumerate(b):
            nxt.append(min(row[j] + (x != y), row[j + 1] + 1, nxt[j] + 1))
        row = nxt
    return row[-1]


pairs = st.text("ab", max_size=14).flatmap(lambda a: st.tuples(st.just(a), st.lists(
    st.tuples(st.sampled_from("idr"), st.integers(0, 14), st.sampled_from("abc")), max_size=4)))


def edited(a, edits):
    b = list(a)
    for kind, at, c in edits:
        at = min(at, len(b))
        if kind == "i":
            b.insert(at, c)
        elif at < len(b):
            if kind == "d":
                del b[at]
            else:
                b[at] = c
    return "".join(b)


@settings(max_examples=400, deadline=None)
@given(pairs, st.integers(1, 4))
def test_banded_distance_and_segments(pair, most):
    a = pair[0]
    b = edited(*pair)
    d = distance(a, b)
    assert within(a, b, most) == (d <= most)
    if d <= most and a != b and min(len(a), len(b)) > most:
        long, short = (a, b) if len(a) >= len(b) else (b, a)
        own = [p for p in probes(len(short), most) if p[4]]
        assert set(segment_keys(long, probes(len(long), most))) & set(segment_keys(short, own))
        line, key, of = LineKeys(["some other line", long, short]).segments(lambda n: np.array(probes(n, most), np.int64))
        assert set(key[line == 1].tolist()) & set(key[(line == 2) & of].tolist())


def brute(docs, most=2, exact=10, similar=20):
    """Cleaned texts, by every pair of lines."""
    first = {}
    order = sorted(((i if i is not None else 1 << 62), k) for k, (i, _) in enumerate(docs))
    for _, k in order:
        i, t = docs[k]
        for n, line in enumerate((t or "").split("\n")):
            s = line.strip()
            if len(s) >= exact:
                place = (i if i is not None else 1 << 62, n)
                first[s] = min(first.get(s, place), place)
    names = list(first)
    root = {s: s for s in names}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s
    for x, a in enumerate(names):
        for b in names[:x]:
            if min(len(a), len(b)) >= similar and abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                root[find(a)] = find(b)
    best = {}
    for s in names:
        best[find(s)] = min(best.get(find(s), (1 << 63, 0)), first[s])
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [line for n, line in enumerate(lines) if len(line.strip()) < exact or best[find(line.strip())] == ((i if i is not None else 1 << 62), n)]
        out.append((i, None if t is None else "\n".join(kept)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(12)
    lines = ["".join(rng.choices("abcdefgh  ", k=rng.randrange(8, 40))) for _ in range(40)]
    docs = []
    for i in range(50):
        t = []
        for _ in range(rng.randrange(1, 7)):
            s = rng.choice(lines)
            if rng.random() < 0.4:
                s = edited(s, [(rng.choice("idr"), rng.randrange(len(s)), rng.choice("abxy")) for _ in range(rng.randrange(1, 4))])
            t.append(rng.choice(["", "  "]) + s)
        docs.append((i, "\n".join(t)))
    return docs


def test_equals_brute_force(spark):
    docs = cases() + [(50, None), (51, ""), (52, "\n\n")]
    got = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == brute(docs)


def test_many_lines_share_a_segment(spark, monkeypatch):
    from scorewright.llm import line_dedup
    monkeypatch.setattr(line_dedup, "similar_lines", lambda t, m, c, f=line_dedup.similar_lines: f(t, m, c, chunk=5))
    docs = [(i, "the very same beginning of a line, then " + format(i * 37 % 64, "06b") * 2) for i in range(64)]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == brute(docs)


def test_linked_compares_sides_only():
    lines = ["abcdefghij", "abcdefghix", "abcdefghiy", "zzzzzzzzzz"]
    q, i = np.array([True, False, False, False]), np.array([False, True, False, True])
    assert linked(lines, q, i, 2) == [(0, 1)]


def test_edges(spark, edge_docs, edge_rows, no_docs):
    got = dedup_lines(edge_docs)
    assert set(got.columns) == {*edge_docs.columns, "lines_removed"}
    rows = got.collect()
    assert len(rows) == len(edge_rows)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[10].text == "line one is long enough\nshort" and by_id[10].lines_removed == 1 and by_id[10].lines_before == 3
    assert by_id[11].text == "something else entirely, really"
    assert by_id[5].text is None and by_id[5].lines_before == 0
    assert [r.text for r in rows if r.doc_id == 3] == ["", ""]  # equal to document 1
    assert dedup_lines(no_docs).collect() == []
    again = spark.createDataFrame([(1, "a line of some length here"), (1, "a line of some length here")], "doc_id long, text string")
    assert [r.text for r in dedup_lines(again).collect()] == ["a line of some length here"] * 2


def test_a_key_travels_as_one_number(spark):
    """Which keys lines meet in is told by one number a key; one that only one line has, twice, links nothing."""
    from scorewright.llm import line_dedup
    rows = [(1, "a" * 40), (2, "the quick brown fox jumps over it"), (3, "the quick brown fox jumped over it")]
    texts = line_dedup._texts(spark.createDataFrame(rows, "doc_id long, text string"))
    keys = line_dedup._keys(texts, 20, 2)
    assert keys.columns == ["key", "seen"]
    assert {r.seen for r in keys.collect()} == {1, 1 + line_dedup._OWN}
    meet = line_dedup._meetings(texts, 20, 2)
    alone = {r.key for r in meet.groupBy("key").count().filter("count = 1").collect()}
    assert alone and not alone & {r.key for r in line_dedup._different(meet).collect()}
    ids = {line_dedup._ids(t)[0] & ~1 for _, t in rows[1:]}
    assert {frozenset(r) for r in line_dedup.similar_lines(texts).collect()} == {frozenset(ids)}
