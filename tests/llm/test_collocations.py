import random
import re
from collections import Counter, defaultdict

import numpy as np

from scorewright.llm import phrase_counts
from scorewright.llm.collocations import collocations
from scorewright.llm.phrase_counts import Words, counted_phrases, counted_words, phrase_hash
from scorewright.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least=100, longest=5, top=2000):
    """The contract's rows by counting every phrase."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and f[q := p[i:j]] == a}
        rows = []
        for p, a in cand.items():
            if p not in gone:
                score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, n, p.decode(), -a, left, right, total[lang], -s) for n, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def corpus(seed=5, lines=500):
    rng = random.Random(seed)
    common, rare = ["the", "of", "and", "La", "é"], [f"w{k}" for k in range(60)]
    fixed = ["New York city council", "of the w1 w2 w3 w4", "rare the end", "w7 the of w8", "ha ha ha ha"]
    docs = []
    for _ in range(lines):
        t = []
        for _ in range(rng.randrange(1, 12)):
            t.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(common if rng.random() < 0.5 else rare))
            t.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]))
        docs.append(("".join(t), rng.choice(["en", "en", "en", "fr", None])))
    return docs


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_equals_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "text string, lang string")
    assert rows(collocations(df, 8, 5, 2000)) == plain(docs, 8, 5, 2000)


def test_floor_prunes_and_rests_are_counted(spark, monkeypatch):
    from scorewright.llm import collocations as module
    passes, expanded = [], []
    count, grow = module._counted, module.Search.grow
    monkeypatch.setattr(module, "FIRST_SHARE", 0.05)
    monkeypatch.setattr(module, "_counted", lambda t, chain, common, n, f=count: passes.append(common is None) or f(t, chain, common, n))
    monkeypatch.setattr(module.Search, "grow", lambda s, w: expanded.extend(r.phrase for r in w.filter("lang = 'en'").collect()) or grow(s, w))
    docs = corpus(6)
    got = rows(collocations(spark.createDataFrame(docs, "text string, lang string"), 8, 5, 2))
    assert got == plain(docs, 8, 5, 2)
    assert any(passes)  # rests that start with words not expanded yet
    assert "the" not in expanded and "rare" in expanded


def test_ties_at_the_last_rank(spark):
    docs = [(f"a{k} b{k}", "en") for k in range(6)] * 4 + [("x y z", "en")] * 9
    assert rows(collocations(spark.createDataFrame(docs, "text string, lang string"), 3, 5, 4)) == plain(docs, 3, 5, 4)


def test_buffers_count_like_one(monkeypatch):
    import pyarrow as pa
    docs = corpus(7, 80)
    batch = pa.RecordBatch.from_arrays([pa.array([d[1] or "und" for d in docs]), pa.array([d[0] for d in docs])], ["lang", "t"])
    every = np.full(8192, 255, np.uint8)

    def total():
        out = Counter()
        for b in [*counted_words([batch]), *counted_phrases([batch], every, every, range(2, 6))]:
            for lang, p, a in zip(*(b.column(k).to_pylist() for k in range(3))):
                out[lang, p] += a
        return out
    whole = total()
    monkeypatch.setattr(phrase_counts, "BUFFER", 50)
    assert total() == whole
    want = Counter()
    for text, lang in docs:
        for piece in re.split("[.,;:!?\n]", text.translate(LOWER)):
            w = piece.split()
            want[lang or "und", ""] += len(w)
            for m in range(1, 6):
                want.update((lang or "und", " ".join(w[i:i + m])) for i in range(len(w) - m + 1))
    assert whole == +want
    w = Words("en", b"one two")
    assert int(phrase_counts.mixed(w.hashes[:1], w.hashes[1:])[0]) == phrase_hash("en", "one two")


def test_edges(spark, edge_docs, no_docs, folder):
    assert collocations(no_docs).collect() == []
    got = collocations(edge_docs, 2, 5, 10)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain([(r.text, r.lang) for r in edge_docs.select("text", "lang").collect()], 2, 5, 10)
    assert rows(got) == want
    no_docs.write.parquet(f"{folder}/documents.parquet")
    assert QUERIES["op11_collocations"](spark, folder).collect() == []


def test_numbered_words_count_like_texts():
    """Frequent phrases as from the texts, though only frequent words are kept; a rare word before a phrase is like none."""
    import pyarrow as pa
    from scorewright.llm.phrase_counts import counted_numbers, numbered_words
    docs = [*corpus(11, 120), *[(f"rare{k} we go on. we go on; rare{k} only{k}", "en") for k in range(9)], ("", "en"), ("alone", "xx")]
    batch = pa.RecordBatch.from_arrays([pa.array([d[1] or "und" for d in docs]), pa.array([d[0] for d in docs])], ["lang", "t"])
    words = Counter()
    for b in counted_words([batch]):
        for lang, p, a in zip(*(b.column(k).to_pylist() for k in range(3))):
            words[lang, p] += a
    common = np.zeros(8192, np.uint8)
    for lang, p in (k for k, a in words.items() if a >= 5 and k[1]):
        h = phrase_hash(lang, p) & 65535
        common[h >> 3] |= 1 << (h & 7)
    every = np.full(8192, 255, np.uint8)

    def total(batches):
        out = defaultdict(list)
        for b in batches:
            for lang, p, *row in zip(*(b.column(k).to_pylist() for k in range(5))):
                out[lang, p].append(row)
        sums = {k: (sum(r[0] for r in v), min(r[1] for r in v), max(r[2] for r in v)) for k, v in out.items()}
        return {k: (a, 0 if x != y else x) for k, (a, x, y) in sums.items() if a >= 5}
    numbered = [*numbered_words([batch], common)]
    assert not any(b"rare1" in n.split() or b"only1" in n.split() for b in numbered for n in b.column(1).to_pylist())
    want = total(counted_phrases([batch], every, common, range(2, 6)))
    assert want and total(counted_numbers(numbered, every, common, range(2, 6))) == want
    assert want["en", "we go on"][0] == 18 and want["en", "we go on"][1] == 0
