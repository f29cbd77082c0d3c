"""Helpers shared by the corpus operators: shared tables, clean-up, byte views of text columns."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, ship_package

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Stands for a missing id inside an operator, so that it sorts behind every real one.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark's setting by which the shuffle files of a query go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back (lineage ends at the files).  What was shuffled for it is
    deleted once it is written, so that a job takes the disk of one step, not of all its steps."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm/{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables made by ``stored`` that no later result reads."""
    for df in frames:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: Texts travel to Python in batches of at most so many rows and bytes.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def prepared(spark: SparkSession) -> None:
    """Python workers must be able to import this package, and get texts in small batches."""
    ship_package(spark)
    for key, most in ARROW.items():
        now = spark.conf.get(key).removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col: Column | str) -> Column:
    """Lower-case A-Z only.  ``lower`` agrees wherever it leaves the non-ASCII part alone, and is much faster."""
    c = F.col(col) if isinstance(col, str) else col
    slow = F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(slow)


def byte_list(column) -> list[bytes]:
    """The rows of an Arrow string column as UTF-8 bytes; null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def in_slices(batches, rows: int = 2000):
    """Arrow batches cut so that at most ``rows`` texts are held as Python objects at once.  In the end what Arrow has
    kept for further batches goes back to the system, since the worker process lives on."""
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    finally:
        pa.default_memory_pool().release_unused()


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)
