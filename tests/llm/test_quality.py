import random

import numpy as np
from pyspark.sql import functions as F

from scorewright.llm import quality as Q


def corpus(n=700):
    rng = random.Random(2)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "se") for b in ("den", "sol", "tir", "vam", "que", "lia")]
    rows, labels = [], []
    for i in range(n):
        w, good = rng.choices(vocabulary, k=rng.randrange(20, 120)), i % 4 != 0
        if not good:
            kind = rng.randrange(4)
            w = ([x.upper() + "!!" for x in w] if kind == 0 else [x for x in w[:12] for _ in range(8)] if kind == 1
                 else [y for x in w for y in (x, "|")] if kind == 2 else [x + rng.choice(["%%%", "$$$"]) for x in w])
        rows.append((i, " ".join(w)))
        labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    d, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    got = Q.score_quality(d, Q.train_quality(d, lab), name="score").withColumn(
        "held", F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()
    truth = dict(labels)
    held = [r for r in got if r.held]
    assert len(got) == len(rows) and len(held) > 50
    assert sum((r.score >= 0.3) == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert abs(np.mean([r.score for r in held]) - np.mean([truth[r.doc_id] for r in held])) < 0.05


def test_vectors_equal_a_plain_count(spark):
    rows, _ = corpus(60)
    got = Q.word_vectors(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    slots, index = Q._Slots(), Q.index_vectors().astype(np.int64)
    sums = np.zeros((Q.SLOTS, Q.DIM))
    for _, t in rows:
        codes = Q._codes(t, slots)
        for i, c in enumerate(codes):
            for j in range(max(0, i - Q.WINDOW), min(len(codes), i + Q.WINDOW + 1)):
                if j != i:
                    around = index[codes[j] // Q.SHAPES] + index[Q.WORDS + codes[j] % Q.SHAPES]
                    sums[c // Q.SHAPES] += around
                    sums[Q.WORDS + c % Q.SHAPES] += around
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = sums / np.maximum(size, 1e-9)
    unit -= (unit * np.log1p(size)).sum(0) / np.log1p(size).sum()
    assert np.allclose(got, unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9), atol=1e-5)


def test_long_texts_are_worked_in_parts(monkeypatch):
    rng = np.random.default_rng(1)
    vectors, text = rng.normal(size=(Q.SLOTS, Q.DIM)).astype(np.float32), corpus(1)[0][0][1] * 5
    whole = Q.pooled(text, Q._Slots(), vectors)
    sums = np.zeros((Q.SLOTS + 1, Q.DIM), np.int64)
    index = np.vstack([Q.index_vectors(), np.zeros((1, Q.DIM), np.int32)])
    Q._contexts(Q._codes(text, Q._Slots()), index, sums)
    monkeypatch.setattr(Q, "STRIDE", 7)
    assert np.allclose(whole, Q.pooled(text, Q._Slots(), vectors), atol=1e-3)
    parts = np.zeros_like(sums)
    Q._contexts(Q._codes(text, Q._Slots()), index, parts)
    assert (sums == parts).all()


def test_temperature_calibrates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 6))
    y = (rng.random(2000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = Q.train_network(x, y, epochs=15)
    p = net.probability(x)
    for lo in (0.0, 0.25, 0.5, 0.75):
        part = (p >= lo) & (p < lo + 0.25)
        assert abs(p[part].mean() - y[part].mean()) < 0.08


def test_edges(spark, edge_docs, no_docs):
    rows, labels = corpus(200)
    d, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, quality int")
    model = Q.train_quality(d, lab)
    got = Q.score_quality(edge_docs, model, name="score")
    assert got.columns == [*edge_docs.columns, "score"] and got.count() == edge_docs.count()
    assert got.filter("score is null or score < 0 or score > 1 or isnan(score)").count() == 0
    assert Q.score_quality(no_docs, model).collect() == []
    one_class = Q.train_quality(no_docs, lab.limit(0))
    assert Q.score_quality(edge_docs, one_class, name="score").filter("score = 0.5").count() == edge_docs.count()
