"""Row numbering within a key that puts no key in one task.

``row_number() OVER (PARTITION BY key ORDER BY o)`` sends every row of a key to one task; when one key can hold a large
share of the data, that task is the whole job.  ``rank_within`` sorts by range of (key, order) instead, so a large key
spreads over as many tasks as it needs.  Each row's place within its task is stored with the row, and shifted by what
earlier tasks hold of the same key.  All keys are numbered alike, whatever their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize


def rank_within(df: DataFrame, keys: list[str], order: list[str], name: str = "rn",
                partitions: int | None = None) -> DataFrame:
    """Add a 1-based ``name`` numbering rows of each ``keys`` group by ``order`` (ties in any order, each number once).

    The sorted rows are written once to the shared folder: task and place are data from then on, so a lost executor
    cannot change them."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [*keys, *order]
    ranged = materialize(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                         .withColumn("__pid", F.spark_partition_id()).withColumn("__pos", F.monotonically_increasing_id()),
                         "ranked")
    spans = ranged.groupBy(*keys, "__pid").agg(F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__cnt"))
    before = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__pid").alias("__p"), "__first",
                         F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__offset"))
    same = F.col("__pid") == F.col("__p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return (ranged.join(spans, same)
            .withColumn(name, (F.col("__pos") - F.col("__first") + 1 + F.col("__offset")).cast("bigint"))
            .drop("__pid", "__pos", "__first", "__offset", "__p", *[f"__k{i}" for i in range(len(keys))]))
