import hashlib

from pyspark.sql import functions as F

from scorewright.llm.licenses import scan_licenses
from scorewright.llm.sharding import assign_shards, write_shards

TEXTS = [
    (1, "Some text.\nLicensed under the Apache License, Version 2.0.\nMore.", "Apache-2.0", ["apache2-grant"]),
    (2, "# Released under the MIT License.", "MIT", ["mit-grant"]),
    (3, "This work is licensed under the GNU General Public License, version 3.", "GPL-3.0", ["gpl3-grant"]),
    (4, "Licensed under   CC BY-NC 4.0. All rights reserved.", "CC-BY-NC", ["cc-by-nc-grant", "all-rights"]),
    (5, "You may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n http://x", "Apache-2.0",
     ["apache2-compliance", "apache2-copy"]),
    (6, "You may obtain a copy of the License at\nYou may not use this file except in compliance with the License.", None,
     ["apache2-copy", "apache2-compliance"]),  # the rule is ordered
    (7, "This licence was lost; permission denied.", None, []),
    (8, None, None, []), (9, "", None, []), (9, "", None, []),
    (None, "ALL RIGHTS RESERVED.", "Proprietary", ["all-rights"]),
    (10, "word " * 50_000 + "\nReleased under the MIT License.", "MIT", ["mit-grant"]),
]


def test_license_rules(spark, edge_docs, no_docs):
    df = spark.createDataFrame([r[:2] for r in TEXTS], "doc_id long, text string")
    got = scan_licenses(df)
    assert sorted(((r.doc_id, r.license, r.sentences) for r in got.collect()), key=str) == sorted(((i, a, s) for i, _, a, s in TEXTS), key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert scan_licenses(edge_docs).count() == edge_docs.count() and scan_licenses(no_docs).collect() == []


def shards_by_hand(rows, limit):
    """Split the one shard on further bits of MD5 until each fits."""
    bits = lambda i: format(int(hashlib.md5(str(i).encode()).hexdigest()[:10], 16), "040b")
    out, todo = {}, [("", rows)]
    while todo:
        name, part = todo.pop()
        if sum(n for _, n in part) <= limit or len(part) == 1:
            out |= {i: name for i, _ in part}
        else:
            todo += [(name + b, [r for r in part if bits(r[0])[len(name)] == b]) for b in "01"]
    return {i: s for i, s in out.items()}


def test_shards_equal_splitting_by_hand(spark):
    rows = [(i, (i * 7919) % 900 + (5000 if i % 97 == 0 else 0)) for i in range(1500)]
    df = spark.createDataFrame([(i, "x" * n) for i, n in rows], "doc_id long, text string")
    for limit in (10**7, 4000, 300):
        got = assign_shards(df, limit=limit).collect()
        assert {r.doc_id: r.shard for r in got} == shards_by_hand(rows, limit)
        sums = {}
        for r in got:
            sums[r.shard] = sums.get(r.shard, 0) + r.bytes
        assert all(r.shard_bytes == sums[r.shard] and (sums[r.shard] <= limit or r.documents == 1) for r in got)


def test_one_key_is_split_by_rows(spark):
    df = spark.createDataFrame([(5, "x" * 100)] * 200 + [(None, "y" * 10)] * 3, "doc_id long, text string")
    got = assign_shards(df, limit=1000).collect()
    assert len(got) == 203 and all(r.shard_bytes <= 1000 for r in got)


def test_shard_edges_and_files(spark, edge_docs, edge_rows, no_docs, folder):
    got = assign_shards(edge_docs, limit=500).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((i for i, *_ in edge_rows), key=str)
    assert assign_shards(no_docs).collect() == []
    docs = spark.createDataFrame([(i, "z" * 50) for i in range(100)], "doc_id long, text string")
    write_shards(docs, f"{folder}/shards", limit=600)
    back = spark.read.parquet(f"{folder}/shards")
    assert back.count() == 100 and back.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).filter("n > 600").count() == 0
