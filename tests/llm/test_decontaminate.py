import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from scorewright.llm.decontaminate import contamination, find_windows, without_contaminated
from scorewright.llm.wumanber import WuManber

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))


def brute(docs, bench, size=10):
    windows = {}
    for item, t in bench:
        w = words(t)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).update({str(item)} - {"None"})
    out = []
    for d, t in docs:
        w, hit, items = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                found = windows.get(tuple(w[i:i + k]))
                if found is not None:
                    hit.update(range(i, i + k))
                    items |= found
        out.append((d, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=1, max_size=12, unique=True),
       st.binary(max_size=300).map(lambda b: bytes(x % 3 + 97 for x in b)))
def test_wu_manber_finds_every_occurrence(patterns, text):
    pos, which = WuManber(patterns).search(text)
    got = sorted(zip(pos.tolist(), which.tolist()))
    assert got == sorted((i, k) for k, p in enumerate(patterns) for i in range(len(text)) if text.startswith(p, i))


def test_lanes_do_not_lose_strings_at_their_ends():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 103, 20_000).astype(np.uint8).tobytes()
    patterns = sorted({text[i:i + 30] for i in range(0, 19_000, 97)})
    pos, which = WuManber(patterns).search(text)
    assert {(p, i) for p, i in zip(pos.tolist(), which.tolist())} == {
        (i, k) for k, p in enumerate(patterns) for i in [m.start() for m in re.finditer(re.escape(p), text)]}


def cases():
    rng = random.Random(4)
    w = [f"w{rng.randrange(60)}é" if rng.random() < .1 else f"w{rng.randrange(60)}" for _ in range(400)]
    bench = [(k, " ".join(w[k * 30:k * 30 + 25])) for k in range(6)] + [(10, "w1 W2"), (11, ""), (12, None), (None, "w3 w4"), (2, " ".join(w[60:85])),
                                                                      (13, "word, with; Punctuation!")]
    docs = [(i, " ".join(rng.choices(w, k=30) + w[(i % 8) * 30:(i % 8) * 30 + rng.randrange(25)] + rng.choices(w, k=5))) for i in range(60)]
    return docs + [(100, None), (101, ""), (102, "..."), (1, docs[1][1]), (103, "a Word with punctuation-b"), (104, "so w3 w4 stand here"), (None, "w1\tw2")], bench


def test_equals_brute_force(spark):
    docs, bench = cases()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    want = brute(docs, bench)
    assert sorted((tuple(r) for r in contamination(d, b).collect()), key=str) == want
    assert sorted((tuple(r) for r in contamination(d, b, block_bytes=300).collect()), key=str) == want  # in several blocks


def test_edge_rows_and_empty_tables(spark, edge_docs, edge_rows, no_docs):
    bench = [(1, edge_rows[0][1])]
    b = spark.createDataFrame(bench, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert sorted((tuple(r) for r in contamination(edge_docs, b).collect()), key=str) == brute([r[:2] for r in edge_rows], bench)
    assert contamination(edge_docs, none).filter("contaminated").count() == 0
    assert contamination(no_docs, b).collect() == [] and find_windows(no_docs, none).collect() == []
    clean = without_contaminated(edge_docs, b)
    assert clean.columns == edge_docs.columns and clean.count() == sum(not r[-1] for r in brute([r[:2] for r in edge_rows], bench))
