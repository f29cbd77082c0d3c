"""Operator 2: exact deduplication as a stateful stream, in DataFrame operations only.

Two chained streams run over whatever files have arrived and stop.  The first turns texts into a digest log: digest, row
id and content locator (file and row number).  The second keeps one state entry per digest in RocksDB, on disk and
without expiry: the row that stays, its locator, and the number of rows seen.  Both resume from their checkpoints.
Digests that were hit more than once are then checked on their full bytes, fetched through the locators."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import ascii_lower, stored

#: The filter in front of the byte check: this many bitmaps of 4 KB, 16 MB in all, whatever the number of hits.
BITMAPS, BITS = 4096, 32768
LOG = "digest binary, id long, file string, row long"
ENTRIES = "digest binary, keep struct<id: long, file: string, row: long>, seen long, batch long"
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # many small stores: files take the room they need, and a commit writes its changes, not the whole store
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _disk_backed(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text.cast("string"), F.lit("")))


def _located(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"),
                     F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def digest_log(spark: SparkSession, path: str, at: str, id_col: str, text_col: str) -> None:
    """Append digest, id and locator of every new row under ``path`` to the log at ``at``."""
    schema = spark.read.parquet(path).schema
    files = f"{path[:-1]}[{path[-1]}]"  # only as a glob may the path of a file source be one file
    rows = _located(spark.readStream.schema(schema).parquet(files), id_col, text_col)
    log = rows.select(F.unhex(F.sha2(normalised(F.col("t")), 256)).alias("digest"), "id", "file", "row")
    (log.writeStream.format("parquet").option("path", f"{at}/log").option("checkpointLocation", f"{at}/log-state")
     .trigger(availableNow=True).start().awaitTermination())


def update_state(spark: SparkSession, at: str) -> None:
    """Bring the keyed state up to date with the log; every batch appends the entries it changed."""
    log = spark.readStream.schema(LOG).parquet(f"{at}/log")
    entries = log.groupBy("digest").agg(F.max(F.struct("id", "file", "row")).alias("keep"),
                                        F.count(F.lit(1)).alias("seen"))

    def put(changed: DataFrame, batch: int) -> None:
        changed.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{at}/entries/part={batch}")

    with _disk_backed(spark):
        (entries.writeStream.outputMode("update").foreachBatch(put)
         .option("checkpointLocation", f"{at}/entries-state").trigger(availableNow=True).start().awaitTermination())


def _byte_groups(spark, path, members: DataFrame, id_col, text_col) -> DataFrame:
    """``members`` (digest, file, row) with their normalised text.  Only rows that pass a bitmap of the members'
    locators are moved; a locator is unique, so this join has no hot key."""
    h = F.xxhash64("file", "row")
    slot = [F.pmod(h, F.lit(BITMAPS)).alias("slot"), F.pmod(F.shiftright(h, 12), F.lit(BITS)).alias("bit")]
    maps = members.select(*slot).groupBy("slot").agg(F.bitmap_construct_agg("bit").alias("bits"))
    texts = _located(spark.read.parquet(path), id_col, text_col).select("*", *slot)
    byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    some = (texts.join(F.broadcast(maps), "slot")
            .filter(byte.bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0).select("file", "row", "id", "t"))
    return members.join(some, ["file", "row"]).select("digest", "id", "file", "row", normalised(F.col("t")).alias("t"))


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                at: str | None = None) -> DataFrame:
    """One row per row of the Parquet files under ``path``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  Of equal texts the row with the
    largest id stays; of repeated rows with that id the one with the last locator; a null id is smaller than any.
    Other columns are not read, whatever their names; an empty table gives an empty result.  With ``at`` (a folder
    all executors share) the state is kept and a later call takes in only files that are new."""
    path = path.rstrip("/")
    at = at or shared_dir(spark, f"llm/exact-{uuid.uuid4().hex}")
    digest_log(spark, path, at, id_col, text_col)
    update_state(spark, at)
    log = spark.read.schema(LOG).parquet(f"{at}/log")
    entries = spark.read.schema(ENTRIES).parquet(f"{at}/entries")
    # stored, so that the join is dealt by itself and a digest that many rows share can be split
    hits = stored(entries.filter("seen > 1").groupBy("digest").agg(F.max(F.struct("batch", "keep", "seen")).alias("e"))
                  .select("digest", "e.keep", "e.seen"), "exact-hits")
    rows = log.join(hits, "digest", "left")
    members = _byte_groups(spark, path, rows.filter("seen is not null").select("digest", "file", "row"), id_col, text_col)
    variants = members.groupBy("digest", "t").agg(F.max(F.struct("id", "file", "row")).alias("own"),
                                                  F.count(F.lit(1)).alias("times"))
    clashes = f"{at}/clashes-{uuid.uuid4().hex}"
    variants.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").write.parquet(clashes)
    clash = spark.read.parquet(clashes)
    if not clash.isEmpty():  # equal digests, different bytes: their rows are grouped by the bytes themselves
        split = (members.join(clash, "digest", "left_semi").join(variants, ["digest", "t"])
                 .select("file", "row", "own", "times"))
        rows = (rows.join(split, ["file", "row"], "left").withColumn("keep", F.coalesce("own", "keep"))
                .withColumn("seen", F.coalesce("times", "seen")))
    kept = F.col("seen").isNull() | ((F.col("keep.file") == F.col("file")) & (F.col("keep.row") == F.col("row")))
    return rows.select(F.col("id").alias("doc_id"),
                       F.when(F.col("seen").isNull(), F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
                       F.coalesce("seen", F.lit(1)).alias("group_size"), kept.alias("kept"),
                       F.lower(F.hex("digest")).alias("text_sha256"))
