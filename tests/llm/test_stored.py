"""Tables between the steps of a job."""

import os
import time

from pyspark.sql import functions as F

from scorewright.llm.common import SHUFFLE_CLEANUP, discard, stored


def _shuffled(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (os.path.basename(files.apply(i).getPath()) for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_what_a_stored_table_shuffled_is_deleted(spark):
    before, mode = _shuffled(spark), spark.conf.get(SHUFFLE_CLEANUP)
    sums = spark.range(20_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.sum("id").alias("s"))
    out = stored(sums, "sums")
    until = time.time() + 20
    while _shuffled(spark) - before and time.time() < until:  # the files go in the background
        time.sleep(0.2)
    assert not _shuffled(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == mode
    assert out.count() == 1000 and sums.count() == 1000
    discard(out)
