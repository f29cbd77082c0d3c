"""Sinks: preprocess info, failure reports, keyed ledgers, text reports (K1-K6).

Every sink writes rows (parquet or JSON lines) or globally ordered text parts; nothing is gathered into one task.
Outputs are partitioned by day and run and written with dynamic partition overwrite: a repeated run replaces exactly
its own rows, another run of the same day adds to them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import reports as R
from ..operators.ranking import rank_within
from ..session import materialize, path_exists

RUN = ("run_date", "run_id")
SUMMARY_COUNTS = ("total_original_files", "textual_outputs", "visual_outputs", "skipped_files", "failed_files", "scanned_pdfs")


def _stamp(df: DataFrame, run_date: str | None, run_id: str) -> DataFrame:
    day = run_date or _dt.date.today().isoformat()
    return df.withColumns({"run_date": F.lit(day), "run_id": F.lit(run_id)})


def _write(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*RUN).format(fmt).save(path))


def read_runs(spark: SparkSession, path: str, columns: str, fmt: str = "parquet") -> DataFrame:
    """All rows of all runs; ``columns`` is the schema (DDL) of what the sink was given."""
    schema = T.StructType.fromDDL(f"{columns}, run_date string, run_id string")
    return spark.read.schema(schema).format(fmt).load(path)


def write_preprocess_info(info: DataFrame, files: DataFrame, path: str, run_date: str | None = None,
                          run_id: str = "0", fmt: str = "parquet") -> None:
    """K1: per-submission summary rows (``<path>/summary``) and the per-file lists as rows (``<path>/files``, see
    ``preprocess.file_lists``), instead of one nested document per submission."""
    stamp = F.current_timestamp()
    _write(_stamp(info.withColumn("processing_ts", stamp), run_date, run_id), f"{path}/summary", fmt)
    _write(_stamp(files, run_date, run_id), f"{path}/files", fmt)


#: Files that one nested document lists at most.
FILES_PER_DOCUMENT = 1000


def write_preprocess_documents(info: DataFrame, outputs: DataFrame, path: str, run_date: str | None = None, run_id: str = "0",
                               files_per_document: int = FILES_PER_DOCUMENT) -> None:
    """K1 as nested documents (JSON lines, read by ``sources.files.read_preprocess_info``): the submission's name, time, counts
    and the lists of its textual and visual outputs in the order of their paths.

    A submission with more than ``files_per_document`` outputs has several documents, told by ``part``, each with all counts
    and the next of its files: rows are numbered by ``rank_within``, so none is gathered that grows with the submission."""
    ranked = rank_within(outputs.select("submission", "channel", "output_path"), ["submission"], ["channel", "output_path"], "__n")
    lists = {f"{c}_files": F.sort_array(F.collect_list(F.when(F.col("channel") == c, F.col("output_path")))) for c in ("textual", "visual")}
    parts = (ranked.withColumn("part", F.floor((F.col("__n") - 1) / files_per_document))
             .groupBy("submission", "part").agg(*[x.alias(name) for name, x in lists.items()]))
    counts = [F.col(c).cast("bigint").alias(c) for c in SUMMARY_COUNTS]
    none = F.array().cast("array<string>")
    docs = info.select("submission", F.struct(*counts).alias("summary")).join(parts, "submission", "left").select(
        F.col("submission").alias("submission_name"), F.coalesce("part", F.lit(0)).alias("part"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("processing_timestamp"), "summary",
        *[F.coalesce(F.col(name), none).alias(name) for name in lists])
    _write(_stamp(docs, run_date, run_id), path, "json")


def write_failure_report(failures: DataFrame, path: str, run_date: str | None = None, run_id: str = "0",
                         fmt: str = "parquet") -> None:
    """K2: failed files (only submissions that have any) and their counts."""
    stamp = F.current_timestamp()
    _write(_stamp(failures.withColumn("processing_ts", stamp), run_date, run_id), f"{path}/failed_files", fmt)
    _write(_stamp(R.failure_report(failures).withColumn("processing_ts", stamp), run_date, run_id), f"{path}/summary", fmt)


LEDGER_MODES = ("insert", "upsert")


def write_ledger(df: DataFrame, path: str, keys: list[str], run_date: str | None = None, run_id: str = "0",
                 mode: str = "insert", seq: str | None = None) -> DataFrame:
    """K3: add rows by ``keys`` to the ledger at ``path``; returns the rows this run holds.

    ``insert`` (the existence marker): a key that an other run holds is not written again.  ``upsert``: the row replaces
    what earlier runs hold of its key (``read_ledger`` shows the latest run's).  Of several rows of ``df`` with one
    key the one with the greatest ``seq`` counts (without ``seq``, the greatest by all columns).  A repeated run
    writes the same rows again, so it changes nothing."""
    if mode not in LEDGER_MODES:
        raise ValueError(f"mode must be one of {LEDGER_MODES}")
    spark = df.sparkSession
    day = run_date or _dt.date.today().isoformat()
    order = F.struct(*([F.col(seq)] if seq else []), *[F.col(c) for c in df.columns if c not in keys])
    row = F.struct(*[F.col(c) for c in df.columns])
    once = df.groupBy(*keys).agg(F.max_by(row, order).alias("row")).select("row.*")
    if mode == "insert" and path_exists(spark, path):
        others = read_runs(spark, path, df.schema.toDDL()).filter(~((F.col("run_date") == day) & (F.col("run_id") == run_id)))
        once = once.join(others.select(*keys).distinct(), keys, "left_anti").select(*df.columns)
    out = materialize(_stamp(once, day, run_id), "ledger_stage")
    _write(out, path)
    return out.drop(*RUN)


def run_order(run_date: str = "run_date", run_id: str = "run_id") -> F.Column:
    """Runs in turn: by day, then by run id with its numbers taken as numbers (run 9 before run 10)."""
    pieces = F.regexp_extract_all(F.col(run_id), F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))
    padded = F.transform(pieces, lambda x: F.when(x.rlike("^[0-9]"), F.lpad(F.ltrim(x, F.lit("0")), F.lit(40), F.lit("0"))).otherwise(x))
    return F.struct(F.col(run_date), F.array_join(padded, ""), F.col(run_id))


def read_ledger(spark: SparkSession, path: str, columns: str, keys: list[str]) -> DataFrame:
    """The current row of each key: that of the latest run (``run_order``).  No ledger yet: no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], T.StructType.fromDDL(columns))
    rows = read_runs(spark, path, columns)
    names = [f.name for f in T.StructType.fromDDL(columns)]
    latest = F.max_by(F.struct(*names), run_order(*RUN))
    return rows.groupBy(*keys).agg(latest.alias("row")).select("row.*")


def write_manifests(manifests: DataFrame, path: str, run_date: str | None = None, run_id: str = "0") -> None:
    """K4: solution manifests as rows, read back with ``read_runs``."""
    _write(_stamp(manifests, run_date, run_id), path)


# FIXED VALUES: layout of the processing report and of the list of invalid submissions
RULE = "=" * 80
SUB_RULE = "-" * 40
DETAIL_RULE = "-" * 50
REPORT_HEAD = ("COMPREHENSIVE PROCESSING REPORT", "Generated: ", "Total Submissions Processed: ")
SUMMARY_TITLES = {"parsing": "PARSING SUMMARY:", "grading": "GRADING SUMMARY:"}
STATUS_TITLES = {"success": "✓ Successful: ", "skipped": "⏭ Skipped: ", "failed": "✗ Failed: "}
DETAILS = "DETAILED RESULTS"
RESULT_TITLES = {"parsing": "PARSING RESULTS:", "grading": "GRADING RESULTS:"}
DETAIL_TITLES = {("parsing", "success"): "✓ SUCCESSFUL PARSING:", ("parsing", "skipped"): "⏭ SKIPPED PARSING:",
                 ("parsing", "failed"): "✗ FAILED PARSING:", ("grading", "success"): "✓ SUCCESSFUL GRADING:",
                 ("grading", "skipped"): "⏭ SKIPPED GRADING:", ("grading", "failed"): "✗ FAILED GRADING:"}
BULLET = "  • "
REPORT_END = "END OF REPORT"
INVALID_HEAD = "=== INVALID SUBMISSIONS SUMMARY ==="
INVALID_TOTAL = "Total invalid submissions: "
INVALID_NAME, INVALID_REPORT = "Submission: ", "Report: "
# end of fixed values

STAGES = ("parsing", "grading")
STATUSES = ("success", "skipped", "failed")
_LINE = "pos int, name string, line string"


def report_lines(results: DataFrame, generated: str) -> DataFrame:
    """K5: the processing report as rows (pos, name, line); in the order of these three columns they are the report."""
    spark = results.sparkSession
    rows = materialize(R.stage_rows(results), "report_rows")  # counts, titles and names from one evaluation
    fixed = [(0, RULE), (1, REPORT_HEAD[0]), (2, RULE), (3, REPORT_HEAD[1] + generated), (5, ""), (30, RULE), (31, DETAILS),
             (32, RULE), (33, ""), (200, RULE), (201, REPORT_END), (202, RULE)]
    kinds = []
    for s, stage in enumerate(STAGES):
        fixed += [(10 + 10 * s, SUMMARY_TITLES[stage]), (11 + 10 * s, SUB_RULE), (15 + 10 * s, ""),
                  (40 + 50 * s, RESULT_TITLES[stage]), (41 + 50 * s, DETAIL_RULE)]
        kinds += [(stage, status, 12 + 10 * s + t, STATUS_TITLES[status], 50 + 50 * s + 10 * t, DETAIL_TITLES[stage, status])
                  for t, status in enumerate(STATUSES)]
    kind = F.broadcast(spark.createDataFrame(kinds, "stage string, status string, count_pos int, count_title string, "
                                                    "list_pos int, list_title string"))
    counts = kind.join(rows.groupBy("stage", "status").agg(F.count(F.lit(1)).alias("n")), ["stage", "status"], "left")
    summary = counts.select(F.col("count_pos").alias("pos"), F.lit("").alias("name"),
                            F.concat("count_title", F.coalesce("n", F.lit(0)).cast("string")).alias("line"))
    around = counts.filter("n > 0").select(F.inline(F.array(
        F.struct(F.col("list_pos").alias("pos"), F.lit("").alias("name"), F.col("list_title").alias("line")),
        F.struct((F.col("list_pos") + 2).alias("pos"), F.lit("").alias("name"), F.lit("").alias("line")))))
    total = rows.agg(F.count_if(F.col("stage") == STAGES[0]).alias("n")).select(
        F.lit(4).alias("pos"), F.lit("").alias("name"), F.concat(F.lit(REPORT_HEAD[2]), F.col("n").cast("string")).alias("line"))
    name = F.col("submission").cast("string")
    names = rows.join(kind, ["stage", "status"]).select(
        (F.col("list_pos") + 1).alias("pos"), name.alias("name"),
        F.when(F.col("status") == "success", F.concat(F.lit(BULLET), name))
        .otherwise(F.concat(F.lit(BULLET), name, F.lit(" - "), F.col("reason"))).alias("line"))
    head = spark.createDataFrame([(p, "", line) for p, line in fixed], _LINE)
    return head.unionByName(total).unionByName(summary).unionByName(around).unionByName(names)


def _write_lines(lines: DataFrame, path: str, partitions: int | None) -> None:
    """Text parts in the order of (pos, name, line), read back in part order."""
    n = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["pos", "name", "line"]
    (lines.repartitionByRange(n, *order).sortWithinPartitions(*order).select("line")
     .write.mode("overwrite").text(path))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of a report written in parts; numbers start at 1."""
    parts = (spark.read.text(path, wholetext=True)
             .select(F.regexp_extract("_metadata.file_name", r"part-([0-9]+)", 1).cast("int").alias("part"),
                     F.split(F.regexp_replace("value", r"\n\z", ""), "\n", -1).alias("lines")))
    sizes = parts.select(F.col("part").alias("earlier"), F.size("lines").alias("n"))  # one row per part
    before = (parts.select("part").join(sizes, F.col("earlier") < F.col("part"), "left")
              .groupBy("part").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("base")))
    return (parts.join(before, "part").select("base", F.posexplode("lines").alias("k", "line"))
            .select((F.col("base") + F.col("k") + 1).cast("bigint").alias("line_no"), "line"))


def write_processing_report(results: DataFrame, path: str, generated: str | None = None,
                            partitions: int | None = None) -> None:
    """K5: the text report, written as globally ordered parts."""
    gen = generated or _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    _write_lines(report_lines(results, gen), path, partitions)


def write_invalid_report(invalid: DataFrame, path: str, key: str = "submission", partitions: int | None = None) -> None:
    """K6: one entry per (submission, kind), in the order of their report names, below their number."""
    spark = invalid.sparkSession
    report = F.concat(F.col(key).cast("string"), F.lit("_"), F.col("kind"), F.lit(".txt"))
    one = invalid.select(F.col(key).cast("string").alias("who"), report.alias("name")).distinct()
    head = spark.createDataFrame([(0, "", INVALID_HEAD), (1, "", ""), (3, "", "")], _LINE)
    total = one.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(2).alias("pos"), F.lit("").alias("name"), F.concat(F.lit(INVALID_TOTAL), F.col("n").cast("string")).alias("line"))
    entries = one.select(F.lit(4).alias("pos"), "name", F.concat(
        F.lit(INVALID_NAME), F.col("who"), F.lit("\n" + INVALID_REPORT), F.col("name"), F.lit("\n" + DETAIL_RULE)).alias("line"))
    _write_lines(head.unionByName(total).unionByName(entries), path, partitions)


__all__ = ["write_preprocess_info", "write_failure_report", "write_ledger", "read_ledger", "read_runs", "write_processing_report", "write_manifests",
           "write_invalid_report", "report_lines", "read_report"]
