from collections import Counter

from pyspark.sql import functions as F

from scorewright.llm.sharding import write_shards


def test_null_and_repeated_ids_are_written_once_each(spark, edge_docs, folder):
    rows = [(None, "n" * 40, "a")] * 5 + [(7, "r" * 50, "b")] * 20 + [(7, "s" * 50, "c")] + [(i, "z" * 30, "d") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    write_shards(docs, f"{folder}/shards", limit=200)
    back = spark.read.parquet(f"{folder}/shards")
    assert Counter((r.doc_id, r.text, r.lang) for r in back.collect()) == Counter(rows)
    assert back.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).filter("n > 200").count() == 0
    write_shards(edge_docs, f"{folder}/edges", limit=500)
    old = [c for c in edge_docs.columns if c != "shard"]
    assert spark.read.parquet(f"{folder}/edges").select(old).exceptAll(edge_docs.select(old)).count() == 0
    assert spark.read.parquet(f"{folder}/edges").count() == edge_docs.count()
