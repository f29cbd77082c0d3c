import hashlib

from scorewright.llm.exact_dedup import exact_dedup


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    return {k: (max((i for i in v if i is not None), default=None), len(v)) for k, v in groups.items()}


def check(got, rows):
    want = expected(rows)
    assert len(got) == len(rows)
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    for r in got:
        assert (r.keep_id, r.group_size) == by_hash[r.text_sha256]
        assert not r.kept or r.doc_id == r.keep_id
    for h, _ in by_hash.items():
        assert sum(r.kept for r in got if r.text_sha256 == h) == 1


def test_edge_rows(spark, edge_docs, edge_rows, as_table):
    check(exact_dedup(spark, as_table(edge_docs)).collect(), [(i, t) for i, t, *_ in edge_rows])


def test_only_ascii_letters_fold(spark, as_table):
    rows = [(1, "ÄB"), (2, "äb"), (3, "Äb"), (4, "İI"), (5, "İi"), (6, "ΣA"), (7, "Σa")]
    check(exact_dedup(spark, as_table(spark.createDataFrame(rows, "doc_id long, text string"))).collect(), rows)


def test_large_group_over_many_partitions(spark, as_table):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    check(exact_dedup(spark, as_table(spark.createDataFrame(rows, "doc_id long, text string").repartition(13))).collect(), rows)


def test_empty_table(spark, no_docs, as_table):
    assert exact_dedup(spark, as_table(no_docs)).collect() == []


def test_state_goes_on_with_new_files(spark, folder, as_table):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    path, at = as_table(first), f"{folder}/state"
    assert exact_dedup(spark, path, at=at).filter("kept").count() == 2
    second = [(3, "A"), (4, "c")]
    spark.createDataFrame(second, "doc_id long, text string").write.mode("append").parquet(path)
    check(exact_dedup(spark, path, at=at).collect(), [(1, "a"), (2, "b"), *second])


def test_equal_digests_with_other_bytes_are_told_apart(spark, as_table, monkeypatch):
    from scorewright.llm import exact_dedup as module
    from pyspark.sql import functions as F
    monkeypatch.setattr(module.F, "sha2", lambda c, n: F.lpad(F.hex(F.length(c) % 2), 64, "0"))
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "c"), (5, "d"), (6, "c")]
    got = module.exact_dedup(spark, as_table(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got} == {
        1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True), 4: (6, 2, False), 5: (5, 1, True), 6: (6, 2, True)}


def test_main_path_is_native(spark, as_table, edge_docs):
    plan = exact_dedup(spark, as_table(edge_docs))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow"))
