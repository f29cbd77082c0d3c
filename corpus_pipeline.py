"""A training-data pipeline: five corpus operators over ``documents``, each stage written and read again.

Toxic documents go; of repeated and nearly repeated lines the first occurrence stays; of near-duplicate documents one
stays; documents with benchmark windows go; what is left is packed into training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm.common import DOC_COLUMNS, stored, table
from scorewright.llm.decontaminate import without_contaminated
from scorewright.llm.line_dedup import dedup_lines
from scorewright.llm.packing import pack_documents
from scorewright.llm.queries import vocabulary
from scorewright.llm.simhash import keep_one
from scorewright.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half."""
    return without_toxic(docs.select(*DOC_COLUMNS), table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand in an earlier one or further up; ``n_chars`` is counted anew."""
    out = dedup_lines(docs.select(*DOC_COLUMNS), min_exact=1)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*DOC_COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id."""
    return keep_one(docs.select(*DOC_COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return without_contaminated(docs.select(*DOC_COLUMNS), table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' tokens in sequences of 2048."""
    return pack_documents(docs.select(*DOC_COLUMNS), vocabulary())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]

#: Learned scores, edit joins, fingerprints and token ids are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``; an empty table gives an empty result."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
