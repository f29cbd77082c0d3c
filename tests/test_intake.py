"""Keys repeated over batches and restarts come once; a batch reads its state, not the ledger."""

from scorewright.streaming.intake import known_keys, stream_intake

FILES = "submission string, path string, name string, size_bytes bigint, content string"


def _drop(spark, folder, *paths):
    rows = [("S", p, p.rsplit("/", 1)[-1], 5, "hello") for p in paths]
    spark.createDataFrame(rows, FILES).coalesce(1).write.mode("append").parquet(folder)


def test_repeated_keys_over_batches_and_restarts(spark, tmp_path):
    source, ledger, state = (str(tmp_path / x) for x in ("in", "ledger", "state"))
    taken = []
    for paths in (("/a.txt", "/b.txt", "/a.txt"), ("/b.txt", "/c.txt"), ("/a.txt", "/c.txt", "/d.npy")):
        _drop(spark, source, *paths)
        run = stream_intake(spark, source, ledger, state, lambda df: df)
        run.awaitTermination()
        taken.append(sum(p["stateOperators"][0]["numRowsUpdated"] for p in run.recentProgress if p["stateOperators"]))
        plan = run._jsq.explainInternal(False)
        assert "Dedup" in plan and ledger not in plan
    rows = spark.read.parquet(ledger).select("path", "skip_reason").collect()
    assert sorted(r.path for r in rows) == ["/a.txt", "/b.txt", "/c.txt", "/d.npy"]
    assert taken == [2, 1, 1]
    assert sorted(r.path for r in known_keys(spark, state).collect()) == ["/a.txt", "/b.txt", "/c.txt", "/d.npy"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").find("RocksDB") < 0
