import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, kinds=400):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(3)
    base = " ".join(words(rng, 120))
    near = base.split()
    near[5] = "changed"
    long = " ".join(words(rng, 60_000, 5000))
    texts = [(1, base), (2, " ".join(near)), (3, base), (3, base), (4, ""), (5, None), (None, None), (None, "lonely words here"),
             (6, long), (7, "one"), (8, "\n\n \t\n"), (9, base.upper()), (10, "line one is long enough\nline one is long enough\nshort"),
             (11, "line one is long enouhg\nsomething else entirely, really")]
    return [(i, t, None if (i or 0) % 2 else "en", "src0" if (i or 0) % 3 else None, None if t is None else len(t)) for i, t in texts]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The edge rows with extra columns named like the operators' own."""
    df = spark.createDataFrame(edge_rows, COLUMNS)
    for c in ("row", "id", "t", "hits", "items", "n_words", "gone", "lines_before", "component_id", "times", "winner", "toxicity",
              "quality", "shard", "bytes", "fp", "i", "m", "mark", "h"):
        df = df.withColumn(c, F.lit(f"extra-{c}"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="sw-llm-")


@pytest.fixture
def as_table(folder):
    def write(df, name="documents"):
        path = os.path.join(folder, f"{name}.parquet")
        df.write.parquet(path)
        return path
    return write
