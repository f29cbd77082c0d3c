"""Submission listings and small JSON/text inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def list_submissions(dirs: DataFrame, dir_col: str = "dir") -> DataFrame:
    """Submission folders, names starting with '#' are reserved outputs."""
    return dirs.filter(~F.col(dir_col).startswith("#")).select(dir_col).distinct()


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file UTF-8 reads (hints, markdown): (file_path, text)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text")))


SCAN_SCHEMA = T.StructType([
    T.StructField("submission", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("size_bytes", T.LongType()),
])


_FOUND = T.StructType([*SCAN_SCHEMA.fields, T.StructField("is_folder", T.BooleanType())])


#: Names that one batch of a listing has at most.
_NAMES = 10_000


def _list_folders(batches):
    """What stands directly in each folder (submission, folder), ten thousand names at a time; small folders share a batch."""
    import os
    import pyarrow as pa
    from pyarrow import fs

    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_()]

    def batch(rows):
        return pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows), types)), [f.name for f in _FOUND.fields])

    rows = []
    for given in batches:
        for sub, folder in zip(given.column(0), given.column(1)):
            sub, folder = sub.as_py(), folder.as_py()
            store, path = fs.FileSystem.from_uri(folder)
            local, prefix = isinstance(store, fs.LocalFileSystem), folder[:folder.find("://") + 3] if "://" in folder else ""
            for x in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                is_folder = x.type == fs.FileType.Directory
                if is_folder and local and os.path.islink(x.path):
                    continue
                rows.append((sub, x.path if local else prefix + x.path, x.base_name, x.size, is_folder))
                if len(rows) == _NAMES:
                    yield batch(rows)
                    rows = []
    if rows:
        yield batch(rows)
    pa.default_memory_pool().release_unused()  # the worker process lives on


def scan_files(spark: SparkSession, root: str, partitions: int | None = None) -> DataFrame:
    """Every file below each submission folder of ``root`` (hidden, zero-byte and ``__MACOSX`` files included, unlike
    ``binaryFile``).  ``root`` is a path or the URI of any store that Arrow's file systems open.

    Breadth first: in each round tasks list the folders that the round before found, so a deep or wide submission is
    spread like any other and the driver lists nothing; there are as many rounds as the tree is deep.  Linked folders
    are not entered; files directly in ``root`` belong to no submission.  Content is read later, only for the rows that need it."""
    from ..session import materialize, ship_package

    ship_package(spark)
    n = partitions or spark.sparkContext.defaultParallelism * 4
    level = spark.createDataFrame([(None, root)], "submission string, folder string")
    out = spark.createDataFrame([], SCAN_SCHEMA)
    while True:
        found = materialize(level.mapInArrow(_list_folders, _FOUND), "folder_listing")
        out = out.unionByName(found.filter("NOT is_folder AND submission IS NOT NULL").drop("is_folder"))
        folders = found.filter("is_folder").select(F.coalesce("submission", "name").alias("submission"), F.col("path").alias("folder"))
        if folders.isEmpty():
            return out
        level = folders.repartition(n, "folder")


def write_file_tree(files: DataFrame, root: str) -> DataFrame:
    """Write each row's ``content`` as a real file ``<root>/<rel>`` from the
    executors (``rel`` = path below the inventory root) and return
    (path, bytes_written).  Needs ``root`` on a POSIX-mounted shared folder."""
    if "://" in root and not root.startswith("file:"):
        raise ValueError("write_file_tree needs a POSIX-mounted folder")
    base = root[5:] if root.startswith("file:") else root
    from ..session import ship_package
    ship_package(files.sparkSession)

    def write(batches):
        import os as _os
        import pyarrow as pa
        made = None
        for batch in batches:
            paths, sizes = [], []
            # one text at a time leaves the batch
            for rel, content in zip(batch.column(0), batch.column(1)):
                rel, content = rel.as_py(), content.as_py()
                target = _os.path.join(base, rel.lstrip("/"))
                if made != _os.path.dirname(target):
                    made = _os.path.dirname(target)
                    _os.makedirs(made, exist_ok=True)
                data = content.encode("utf-8") if isinstance(content, str) else bytes(content or b"")
                with open(target, "wb") as fh:
                    fh.write(data)
                paths.append(target)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "bytes_written"])
        pa.default_memory_pool().release_unused()  # the worker process lives on

    return files.select("rel", "content").mapInArrow(write, "path string, bytes_written long")


def read_file_contents(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """Attach ``content`` to listed files: a ``binaryFile`` scan of ``root``
    (Spark prunes to path/content) joined on ``path``.  Files that
    ``binaryFile`` hides (hidden, zero-byte) come back with null content."""
    blobs = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select(F.regexp_replace("path", "^file:", "").alias("path"), "content"))
    return files.join(blobs, "path", "left")


PREPROCESS_INFO_SCHEMA = T.StructType([
    T.StructField("submission_name", T.StringType()),
    T.StructField("processing_timestamp", T.StringType()),
    T.StructField("summary", T.StructType([
        T.StructField(n, T.LongType()) for n in
        ("total_original_files", "textual_outputs", "visual_outputs", "skipped_files", "failed_files", "scanned_pdfs")])),
    T.StructField("textual_files", T.ArrayType(T.StringType())),
    T.StructField("visual_files", T.ArrayType(T.StringType())),
])


def read_preprocess_info(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """preprocess_info.json files (one document per file, or JSON lines
    with ``multi_line=False``); missing or malformed -> nulls, not errors."""
    schema = T.StructType(PREPROCESS_INFO_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
    return (spark.read.schema(schema)
            .option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
            .withColumn("file_path", F.col("_metadata.file_path")))


def read_usage_ledger(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """grading_metadata.json files -> one row per (file, stage); bad JSON -> no rows.  ``one_per_line``: files of one
    document a line, whose ``submission`` is returned too."""
    raw = (spark.read.text(path, wholetext=not one_per_line)
           .select(F.col("_metadata.file_path").alias("file_path"), F.try_parse_json("value").alias("v")))
    stages = raw.filter(F.col("v").isNotNull()).selectExpr("file_path", "v")
    if one_per_line:
        stages = stages.withColumn("submission", F.try_variant_get("v", "$.submission", "string"))
    out = None
    for stage in ("parsing", "grading"):
        s = stages.select("file_path", *(["submission"] if one_per_line else []), F.lit(stage).alias("stage"),
                          *[F.try_variant_get("v", f"$.{stage}.{k}", t).alias(k) for k, t in (
                              ("prompt_tokens", "bigint"), ("completion_tokens", "bigint"), ("total_tokens", "bigint"),
                              ("cost_usd", "double"), ("model_type", "string"), ("processing_time_seconds", "double"),
                              ("files_processed", "bigint"))]).filter(F.col("model_type").isNotNull())
        out = s if out is None else out.unionByName(s)
    return out


MANIFEST_KEYS = ("parsed_solution_path", "structure_hint_path")


def check_solution_manifest(manifests: DataFrame, existing: DataFrame, key: str = "assignment_id",
                            text_col: str = "manifest") -> DataFrame:
    """Manifest JSON text -> (key, valid, invalid_reason, solution_path,
    hint_path).  Malformed JSON, a missing required key, or a target that is
    not in ``existing`` (a listing with column ``path``) makes it invalid."""
    v = F.try_parse_json(F.col(text_col))
    m = manifests.select(key, v.alias("v"))
    m = m.select(key, F.col("v").isNull().alias("bad_json"),
                 F.try_variant_get("v", "$.parsed_solution_path", "string").alias("solution_path"),
                 F.try_variant_get("v", "$.structure_hint_path", "string").alias("hint_path"))
    paths = existing.select(F.col("path")).distinct()
    sol_ok = paths.select(F.col("path").alias("solution_path"), F.lit(True).alias("sol_exists"))
    hint_ok = paths.select(F.col("path").alias("hint_path"), F.lit(True).alias("hint_exists"))
    j = m.join(sol_ok, "solution_path", "left").join(hint_ok, "hint_path", "left")
    reason = (F.when(F.col("bad_json"), F.lit("Invalid solution info file"))
              .when(F.col("solution_path").isNull() | F.col("hint_path").isNull(),
                    F.lit("Missing required keys in solution info file"))
              .when(F.col("sol_exists").isNull(), F.concat(F.lit("Parsed solution file not found: "), F.col("solution_path")))
              .when(F.col("hint_exists").isNull(), F.concat(F.lit("Structure hint file not found: "), F.col("hint_path"))))
    return j.select(key, reason.isNull().alias("valid"), reason.alias("invalid_reason"), "solution_path", "hint_path")
