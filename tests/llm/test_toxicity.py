import random

from hypothesis import given, settings
from hypothesis import strategies as st

from scorewright.llm.levenshtein import FuzzyLexicon, edits_allowed
from scorewright.llm.toxicity import _Words, hits_of, score_toxicity, train_toxicity, without_toxic
from pyspark.sql import functions as F


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        nxt = [i + 1]
        for j, y in enumerate(b):
            nxt.append(min(row[j] + (x != y), row[j + 1] + 1, nxt[j] + 1))
        row = nxt
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=10), min_size=1, max_size=20, unique=True), st.lists(st.text("abcd", max_size=11), max_size=20))
def test_automaton_equals_edit_distance(terms, words):
    lexicon = FuzzyLexicon(terms, max_states=40)
    for w in words:
        near = [(distance(w, t), i) for i, t in enumerate(terms) if distance(w, t) <= edits_allowed(t)]
        assert lexicon.match(w) == (min(near) if near else None)


def test_quotation_is_told_from_abuse():
    known = _Words(FuzzyLexicon(["moron"]))
    assert hits_of('They wrote "you moron" on the wall', known) == [(0, 0, True)]
    assert hits_of("he said moron twice", known) == [(0, 0, True)]
    assert hits_of("what a moron, honestly", known) == [(0, 0, False)]
    assert hits_of("what a morron!", known) == [(1, 0, False)]


def corpus(n=900):
    rng = random.Random(9)
    vocabulary = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ru") for b in ("den", "sol", "tir", "vam") for c in ("a", "es", "on", "ish", "ul")]
    rows, labels = [], []
    for i in range(n):
        w = rng.choices(vocabulary, k=rng.randrange(5, 60))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randrange(1, 3)):
                bad = rng.choice(["wretchling", "scumbert", "dolthead"])
                if rng.random() < 0.3:
                    k = rng.randrange(2, len(bad))
                    bad = bad[:k] + "x" + bad[k + 1:]
                w.insert(rng.randrange(len(w)), bad)
        rows.append((i, " ".join(w)))
        if i % 4 != 3:
            labels.append((i, int(toxic)))
    return rows, labels, {i: int(i % 5 == 0) for i in range(n)}


def test_held_out_accuracy_and_clean_rows_stay(spark):
    rows, labels, truth = corpus()
    d, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.toxicity for r in score_toxicity(d, train_toxicity(d, lab)).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert sum((s >= 0.5) == bool(truth[i]) for i, s in got.items()) >= 0.97 * len(got)
    kept = {r.doc_id for r in without_toxic(d, lab).collect()}
    assert sum(1 for i in truth if not truth[i] and i not in kept) <= 0.01 * len(truth)


def test_edges(spark, edge_docs, no_docs):
    rows, labels, _ = corpus(300)
    d, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(None, 1), (7, None), (8, 5)], "doc_id long, toxic int")
    model = train_toxicity(d, lab)
    got = score_toxicity(edge_docs, model, name="score")
    assert got.columns == [*edge_docs.columns, "score"] and got.count() == edge_docs.count()
    assert got.filter("score is null or score < 0 or score > 1").count() == 0
    assert score_toxicity(no_docs, model).collect() == []
    clean = without_toxic(edge_docs, lab)
    assert clean.columns == edge_docs.columns and clean.count() == edge_docs.count()
    none = lab.limit(0)
    assert without_toxic(edge_docs, none).count() == edge_docs.count() and without_toxic(no_docs, none).collect() == []


def test_held_out_rows_teach_nothing(spark):
    rows, labels, _ = corpus(300)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = (F.crc32(F.col("doc_id").cast("string")) % 5) == 0
    flipped = lab.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = train_toxicity(d, lab), train_toxicity(d, flipped)
    assert a.terms == b.terms and (a.coef == b.coef).all()
