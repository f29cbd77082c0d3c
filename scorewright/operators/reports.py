"""Roll-ups and reports.

Nothing here gathers an unbounded list into one row: per-status name lists
and per-submission file lists stay rows (sorted on write), only counts and
the per-submission reason summary (bounded by the number of distinct
reasons) are aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import rules


def failure_reason_summary(failures: DataFrame, key: str = "submission") -> DataFrame:
    """A4: '<file>: <reason>' or '<n> files: <reason>' per reason, in
    first-seen order, joined with '; '.  Needs ``order_key`` and ``filename``."""
    per_reason = (failures.groupBy(key, "failure_reason")
                  .agg(F.count(F.lit(1)).alias("n"),
                       F.min("order_key").alias("first_seen"),
                       F.min_by("filename", "order_key").alias("one_file")))
    part = F.when(F.col("n") == 1, F.concat(F.col("one_file"), F.lit(": "), F.col("failure_reason"))) \
        .otherwise(F.concat(F.col("n").cast("string"), F.lit(" files: "), F.col("failure_reason")))
    return (per_reason.groupBy(key)
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_seen", part.alias("t")))),
                                          lambda x: x["t"]), "; ").alias("failure_summary"),
                 F.sum("n").alias("failed_files")))


def failure_report(failures: DataFrame, key: str = "submission") -> DataFrame:
    """A3: count of failed files per submission (a file may fail twice); the
    file list itself is the failures table, written row-wise (K2)."""
    return failures.groupBy(key).agg(F.count(F.lit(1)).alias("total_failed_files"),
                                     F.count_distinct("filename").alias("distinct_files"))


def preprocessing_summary(outcomes: DataFrame) -> DataFrame:
    """A5: one row: total, successful, failed = total - successful."""
    return outcomes.agg(F.count(F.lit(1)).alias("total_submissions"),
                        F.count_if(F.col("success")).alias("successful_preprocessing")) \
        .withColumn("failed_preprocessing", F.col("total_submissions") - F.col("successful_preprocessing"))


def failed_submissions(outcomes: DataFrame) -> DataFrame:
    """A5: name -> reason of failed submissions (fallback 'Unknown error')."""
    return outcomes.filter(~F.col("success")).select(
        "submission", F.coalesce(F.col("failure_reason"), F.lit(rules.UNKNOWN_ERROR)).alias("failure_reason"))


def latest_result(results: DataFrame, key: str = "submission", seq: str = "seq") -> DataFrame:
    """Last write wins per key (``max_by`` aggregates partially, so a hot
    key is pre-reduced on the map side)."""
    value_cols = [c for c in results.columns if c not in (key, seq)]
    latest = F.max_by(F.struct(*value_cols), F.col(seq))
    return results.groupBy(key).agg(latest.alias("__v"), F.max(seq).alias(seq)).select(key, seq, "__v.*")


def _status3(col: str):
    c = F.col(col)
    return F.when(c == "success", "success").when(c == "skipped", "skipped").otherwise("failed")


def stage_rows(results: DataFrame, key: str = "submission") -> DataFrame:
    """Unpivot (parsing, grading) into (submission, stage, status, reason);
    status outside success/skipped counts as failed, reason defaults to 'Unknown'."""
    def one(stage):
        return F.struct(F.lit(stage).alias("stage"), _status3(stage).alias("status"),
                        F.coalesce(F.col(f"{stage}_reason"), F.lit("Unknown")).alias("reason"))

    return results.select(key, F.inline(F.array(one("parsing"), one("grading"))))


def processing_report(results: DataFrame, key: str = "submission") -> DataFrame:
    """Submissions per stage and status (success / skipped / failed)."""
    return stage_rows(results, key).groupBy("stage", "status").agg(F.count(F.lit(1)).alias("n"))


def report_pivot(results: DataFrame, key: str = "submission") -> DataFrame:
    """One row per stage, one column per status."""
    return (stage_rows(results, key).groupBy("stage")
            .pivot("status", ["success", "skipped", "failed"]).agg(F.count(F.lit(1)))
            .na.fill(0, ["success", "skipped", "failed"]))


def run_summary(results: DataFrame) -> DataFrame:
    """Total; success = grading success; failed = total - success (so the
    reference counts skipped as failed); plus the honest skipped count (D9)."""
    return results.agg(F.count(F.lit(1)).alias("total"),
                       F.count_if(F.col("grading") == "success").alias("successful"),
                       F.count_if(F.col("grading") == "skipped").alias("skipped")) \
        .withColumn("failed_reported", F.col("total") - F.col("successful")) \
        .withColumn("failed", F.col("total") - F.col("successful") - F.col("skipped"))


def invalid_summary(invalid: DataFrame, key: str = "submission") -> DataFrame:
    """A10: number of invalid submissions per kind and overall (names stay rows)."""
    return invalid.cube("kind").agg(F.count_distinct(key).alias("n")) \
        .withColumn("kind", F.coalesce(F.col("kind"), F.lit("all")))
