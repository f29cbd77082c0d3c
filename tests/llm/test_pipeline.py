import random

import corpus_pipeline as C
from scorewright.llm.common import DOC_COLUMNS
from scorewright.llm.queries import ORACLES, QUERIES

from test_decontaminate import brute as contaminated
from test_line_dedup import brute as cleaned
from test_packing import check_rows
from test_simhash import plain_components, plain_fingerprint
from test_toxicity import corpus


def test_registered():
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in QUERIES) == 1
    assert "pipeline" in QUERIES and C.ORACLE_SQL is None and set(ORACLES) <= set(QUERIES)
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "simhash", "decontaminate", "packing"]


def tables(spark, folder):
    rng = random.Random(21)
    rows, labels, truth = corpus(260)
    rows = [(i, "\n".join([t, rng.choice(["a line that many share, word for word", f"its own line, number {i * 7919} of some"])])) for i, t in rows]
    rows += [(1000 + i, t) for i, t in rows[1:40:3]] + [(2000, None), (2001, ""), (2001, "")]
    bench = [(1, "the benchmark asks a question of ten words or some more"), (2, "short one")]
    rows += [(3000 + k, f"intro {k * 31} words\n{bench[0][1]} and the rest {k}") for k in range(3)]
    docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, bench, truth


def test_stages_equal_brute_force(spark, folder):
    rows, bench, truth = tables(spark, folder)
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if k < 4:
            assert docs.columns == list(DOC_COLUMNS)
            seen.append([(r.doc_id, r.text, r.n_chars) for r in docs.collect()])
    before = [(i, t) for i, t in rows]
    kept = [r[:2] for r in seen[0]]
    wrong = [i for i, t in before if ((i, t) in kept) == bool(truth.get(i, truth.get(i - 1000, 0)))]
    assert len(wrong) <= 0.03 * len(before)
    assert sorted((r[:2] for r in seen[1]), key=str) == cleaned(kept)
    assert all(n == (None if t is None else len(t)) for _, t, n in seen[1])
    lines = [r[:2] for r in seen[1]]
    root = plain_components([plain_fingerprint(t) for _, t in lines])
    assert sorted(r[0] for r in seen[2]) == sorted(min(i for (i, _), q in zip(lines, root) if q == g) for g in set(root))
    single = [r[:2] for r in seen[2]]
    dirty = {d for d, *_, bad in contaminated(single, bench) if bad}
    assert sorted(r[:2] for r in seen[3]) == sorted(r for r in single if r[0] not in dirty)
    check_rows([r[:2] for r in seen[3]], docs.collect())
    run = C.run(spark, folder)
    assert sorted(tuple(r)[:5] for r in run.collect()) == sorted(tuple(r)[:5] for r in docs.collect())


def test_empty_tables(spark, folder, no_docs):
    no_docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert C.run(spark, folder).collect() == []
