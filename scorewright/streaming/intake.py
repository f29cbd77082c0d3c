"""Process each new file exactly once across restarts.

File-source stream -> F7 classification (stateless) -> one state entry per key, on disk (RocksDB) and without expiry ->
``foreachBatch``: write the batch's own folder of the ledger.  What is known is the state, dealt by key over all tasks, so
a batch costs what it brings and never reads the ledger.  A replayed batch (restart after a failure between write and
commit) starts from the state before it and overwrites its folder, so the sink is idempotent; the checkpoint records
which source files were read.  ``trigger(availableNow=True)`` drains what exists and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import files as FO

# State entries live on disk; a commit uploads the changes, not the whole store.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stream_intake(spark: SparkSession, source: str, ledger_path: str, checkpoint_path: str,
                  to_files: Callable[[DataFrame], DataFrame], source_format: str = "parquet",
                  key: str = "path", max_files_per_trigger: int | None = None, base_path: str | None = None):
    """Start the intake stream; returns the StreamingQuery (already started).

    ``to_files`` maps source rows to the file inventory (submission, path, name, size_bytes, content); classification
    happens per micro-batch.  A key comes once, whatever batch repeats it; of several rows of one key in one batch any
    one stays.  A null key is a key like any other."""
    schema = spark.read.format(source_format).load(source).schema
    reader = spark.readStream.format(source_format).schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    fresh = FO.classify_files(to_files(reader.load(source))).drop("content").dropDuplicates([key])

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{ledger_path}/batch_id={batch_id}")

    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:  # a query keeps the settings that it was started with
        return (fresh.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_path)
                .trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def known_keys(spark: SparkSession, checkpoint_path: str) -> DataFrame:
    """The keys that the intake has taken so far, read from its state."""
    return spark.read.format("statestore").load(checkpoint_path).select("key.*")
