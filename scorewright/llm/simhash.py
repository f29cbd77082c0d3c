"""Operator 3: SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints are made in one pass over the texts.  From then on only distinct fingerprints travel (a third of all
rows may share one).  They are dealt to buckets by exact agreement on some of their bit blocks: with ``max_bits``
differing bits, of ``blocks`` blocks at least ``blocks - max_bits`` agree, so every link meets in some bucket.  Within
a bucket the Gray-order hierarchical index finds the links; a bucket above ``chunk`` rows is cut into chunks, and
each pair of chunks is a task of its own.  Components come from star rounds over the links found."""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, byte_list, partitions_for, prepared, stored
from .components import connected_components
from .hamming import bucket_links

SHINGLE_WORDS, MAX_BITS, SEED, CHUNK = 4, 4, 42, 2048
_BLOCK = 1 << 16


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of one text: bit i is set if it is set in over half of the shingles' hashes; no word gives 0."""
    w = text.lower().split()
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
    n = max(1, len(w) - words + 1)
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), grams), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        part = h[at:at + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, mark, fp) for every row: ``mark`` is a hash of the text, ``fp`` the fingerprint as a signed long.  Null
    text counts as empty."""
    prepared(docs.sparkSession)

    def make(batches):
        import pyarrow as pa
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in byte_list(batch.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps, pa.int64())], ["doc_id", "mark", "fp"])

    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(t).alias("mark"), t.alias("t")
                       ).mapInArrow(make, "doc_id long, mark long, fp long")


def block_keys(fp: Column, rows: int, most: int = MAX_BITS) -> Column:
    """Bucket keys of a fingerprint.  The number of blocks follows the number of fingerprints, so that a bucket of
    evenly spread ones stays at some hundred rows; each choice keeps every link within ``most`` bits."""
    blocks = most + 1
    while blocks < most + 4 and rows >> (64 * (blocks - most) // blocks) > 512:
        blocks += 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for t, chosen in enumerate(combinations(range(blocks), blocks - most)):
        mask = sum(((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(signed)).alias("k")))
    return F.array(*keys)


def fingerprint_links(distinct: DataFrame, most: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp``; their components are those of all links within
    ``most`` bits."""
    spark = distinct.sparkSession
    rows = distinct.count()
    dealt = distinct.select("fp", F.explode(block_keys(F.col("fp"), rows, most)).alias("x")).select("fp", "x.t", "x.k")
    sizes = (dealt.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")))
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    tasks = (dealt.join(sizes, ["t", "k"]).withColumn("c", mine)
             .withColumn("d", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("fp", F.xxhash64("t", "k", F.least("c", "d"), F.greatest("c", "d")).alias("bucket"),
                     (F.col("c") <= F.col("d")).alias("q"), (F.col("c") >= F.col("d")).alias("i")))
    prepared(spark)
    # a bucket is told by a hash: two buckets that clash are searched as one, which adds only true links

    def search(frames):
        held, size = [], 0
        for pdf in frames:
            held.append(pdf)
            size += len(pdf)
            if size >= 200_000:
                pdf = pd.concat(held, ignore_index=True)
                last = pdf.bucket.values != pdf.bucket.values[-1]
                if last.any():
                    yield _linked(pdf[last], most)
                    pdf = pdf[~last]
                held, size = [pdf], len(pdf)
        if held:
            yield _linked(pd.concat(held, ignore_index=True), most)

    n = partitions_for(spark)
    return (tasks.repartition(n, "bucket").sortWithinPartitions("bucket")
            .mapInPandas(search, "a long, b long").distinct())


def _linked(pdf: pd.DataFrame, most: int) -> pd.DataFrame:
    a, b = bucket_links(pdf.bucket.values, pdf.fp.values.view(np.uint64), pdf.q.values, pdf.i.values, most)
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed long), component_id, the smallest doc_id reachable over links
    of at most ``max_bits`` bits.

    Null or wordless texts have fingerprint 0 and link like any other.  Repeated rows each stay.  A null doc_id
    counts as larger than any other; component_id is null if all ids of the component are.  Only the two named
    columns are read, so others may have any name.  An empty table gives an empty result."""
    return _grouped(docs, id_col, text_col, words, max_bits).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, max_bits: int) -> DataFrame:
    """(doc_id, mark, fp, component, component_id) of every row; ``component`` is the least fingerprint of it."""
    marked = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    joined = stored(connected_components(fingerprint_links(classes.select("fp"), max_bits)), "components")
    known = classes.join(joined, F.col("fp") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = stored(known.join(least, "component").select("fp", "component", "component_id"), "by-print")
    return marked.join(by_print, "fp")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents left when of each component only the row with the smallest doc_id stays (null ids come last; of
    rows with one id and different texts, the one whose text has the least hash; of rows alike in both, the least by
    the other columns)."""
    groups = stored(_grouped(docs, "doc_id", "text", words, max_bits).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "mark", "component"), "groups")
    winners = groups.groupBy("component").agg(F.min(F.struct("id", "mark")).alias("w")).select("w.id", "w.mark")
    times = groups.join(winners, ["id", "mark"], "left_semi").groupBy("id", "mark").agg(F.count(F.lit(1)).alias("times"))
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(t).alias("mark"),
                       F.struct("text", *[c for c in docs.columns if c != "text"]).alias("row"))
    here = rows.join(times, ["id", "mark"])
    once = here.filter("times = 1").select("row")
    one = here.filter("times > 1").groupBy("id", "mark").agg(F.min("row").alias("row")).select("row")
    return once.unionByName(one).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
