"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.host": "127.0.0.1",
    # model calls are not idempotent: never run a task twice on purpose
    "spark.speculation": "false",
    # archives and documents travel as whole binaries: bound Arrow batches by bytes
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def get_session(master: str | None = None, app: str = "scorewright",
                shuffle_partitions: int = 8, driver_memory: str = "16g") -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    Only meant for tests, bench and local use; on a cluster the launcher
    supplies the session and its ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only when it is unset (local tests) do
    we set one ourselves, under ``fallback`` or the ``SCOREWRIGHT_CHECKPOINT_DIR``
    variable.
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    target = conf_dir or fallback or os.environ.get("SCOREWRIGHT_CHECKPOINT_DIR")
    if not target and sc.master.startswith("local"):
        # single-machine run (tests, smoke checks): any local folder is shared
        import tempfile
        target = tempfile.mkdtemp(prefix="scorewright-checkpoints-")
    if not target:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for the cluster")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``scorewright`` importable in Python workers (``addPyFile``).

    Python-side operators (archives, documents, model calls, name folding)
    pickle references to this package; executors get it as a zip through
    Spark's own file distribution.  Skipped when the workers can already
    import it (e.g. installed on the cluster image)."""
    import importlib.util
    import tempfile
    import zipfile

    key = id(spark.sparkContext)
    if key in _SHIPPED:
        return
    if os.environ.get("SCOREWRIGHT_INSTALLED") == "1":
        _SHIPPED.add(key)
        return
    spec = importlib.util.find_spec("scorewright")
    pkg_dir = os.path.dirname(spec.origin)
    out = os.path.join(tempfile.mkdtemp(prefix="scorewright-pyfiles-"), "scorewright.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _dirs, names in os.walk(pkg_dir):
            if "__pycache__" in base:
                continue
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(key)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store it names; other errors rise."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


_TABLES: list[str] = []


def drop_tables(spark: SparkSession) -> None:
    """Delete every table that ``materialize`` has written; call it when their results have been read."""
    while _TABLES:
        p = spark._jvm.org.apache.hadoop.fs.Path(_TABLES.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df, name: str):
    """Write ``df`` as a parquet table under the shared checkpoint folder and
    return a DataFrame reading it back: the plan runs once, the lineage is
    cut (a lost executor does not recompute upstream work), and later readers
    get column pruning and filter pushdown on the stored table."""
    import uuid

    path = shared_dir(df.sparkSession, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _TABLES.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
