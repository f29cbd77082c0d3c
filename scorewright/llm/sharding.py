"""Operator 7: sharding by extendible hashing.

The directory maps hash prefixes to shards.  It starts as one shard; a shard above the byte limit splits on the next bit
of the hash, and only such shards do, until each fits.  Sizes are summed for the prefixes of ``STEP`` more bits at a
time, over slim rows that combine before the shuffle, and only rows of shards still too large go on to further bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

LIMIT_BYTES, KEY_BITS, ROW_BITS, STEP = 16 << 20, 40, 20, 12
BITS = KEY_BITS + ROW_BITS


def _md5_bits(value: Column, bits: int) -> Column:
    return F.conv(F.substring(F.md5(value.cast("string")), 1, bits // 4), 16, 10).cast("long")


def hashed(docs: DataFrame, key_col: str, text_col: str, *more: Column) -> DataFrame:
    """(doc_id, h, bytes) and ``more``: ``h`` has ``KEY_BITS`` bits of the key's MD5, then ``ROW_BITS`` of the row's, so that rows with
    one key can be split too.  Row numbers hold once the result is stored."""
    key = F.coalesce(F.col(key_col).cast("string"), F.lit(""))
    row = F.concat(F.monotonically_increasing_id().cast("string"), F.lit("/"), key)
    h = F.shiftleft(_md5_bits(key, KEY_BITS), ROW_BITS).bitwiseOR(_md5_bits(row, ROW_BITS))
    return docs.select(F.col(key_col).alias("doc_id"), h.alias("h"),
                       F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("bytes"), *more)


def directory(rows: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """(depth, prefix, shard_bytes, documents) of every shard of ``rows`` (h, bytes)."""
    todo, level, found = rows.select("h", "bytes"), 0, []
    while True:
        top = min(level + STEP, BITS)
        deepest = todo.groupBy(F.expr(f"shiftrightunsigned(h, {BITS - top})").alias("p")).agg(
            F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        sized = stored(deepest.withColumn("depth", F.explode(F.sequence(F.lit(level), F.lit(top))))
                       .withColumn("prefix", F.expr(f"shiftrightunsigned(p, {top} - depth)"))
                       .groupBy("depth", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("documents")), "prefixes")
        final = (F.col("shard_bytes") <= limit) | (F.col("documents") == 1) | (F.col("depth") == BITS)
        split = sized.filter(~final)
        parents = split.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        ends = (sized.filter(final).withColumn("parent", F.expr("shiftrightunsigned(prefix, 1)"))
                .join(parents, ["depth", "parent"], "left_semi").select("depth", "prefix", "shard_bytes", "documents"))
        found.append(ends)
        if level == 0:
            found.append(sized.filter(final & (F.col("depth") == 0)))
        large = split.filter(F.col("depth") == top).select(F.col("prefix").alias("p"))
        if top == BITS or large.isEmpty():
            break
        rest = stored(todo.withColumn("p", F.expr(f"shiftrightunsigned(h, {BITS - top})"))
                      .join(large, "p", "left_semi").select("h", "bytes"), "oversized")
        if level:
            discard(todo)
        todo, level = rest, top
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _placed(docs: DataFrame, key_col: str, text_col: str, limit: int, *more: Column) -> DataFrame:
    """(doc_id, bytes, shard, shard_bytes, documents) and ``more`` of each row, placed by its own stored hash."""
    rows = stored(hashed(docs, key_col, text_col, *more), "shard-rows")
    shards = stored(directory(rows, limit), "shard-directory")
    depths = sorted(r.depth for r in shards.select("depth").distinct().collect())  # at most BITS + 1 numbers
    # each row offers its prefix at every depth in use; exactly one of them is a shard
    offers = F.array(*[F.lit(d) for d in depths]) if depths else F.array().cast("array<int>")
    placed = (rows.withColumn("depth", F.explode(offers)).withColumn("prefix", F.expr(f"shiftrightunsigned(h, {BITS} - depth)"))
              .join(shards, ["depth", "prefix"]))
    name = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")))
    return placed.select("doc_id", "bytes", name.alias("shard"), "shard_bytes", "documents", *rows.columns[3:])


def assign_shards(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id (the key), bytes, shard (the bits of its prefix, "" for the only shard),
    shard_bytes, documents.

    Bytes are those of the text in UTF-8, null as none.  A shard above the limit is one document (or, past all bits,
    rows of one key whose row hashes agree).  Null keys count as one key.  Repeated rows stay, and may part only where
    their shard is too large.  Other columns are not read; an empty table gives an empty result."""
    return _placed(docs, key_col, text_col, limit)


def write_shards(docs: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BYTES) -> None:
    """Write every row of ``docs`` once, as one folder of Parquet files per shard under ``path``; null and repeated keys
    are placed as by ``assign_shards``.  The folders give the column ``shard``, instead of one of that name."""
    row = F.struct(*[c for c in docs.columns if c != "shard"]).alias("row")
    tagged = _placed(docs, key_col, text_col, limit, row).select("row.*", F.concat(F.lit("s"), "shard").alias("shard"))
    tagged.repartition("shard").write.partitionBy("shard").parquet(path)
